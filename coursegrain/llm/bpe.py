"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a prefix ends in one certain token, so it is enough to store
that last token for every prefix of a word.  At each position the automaton over
the vocabulary lists the tokens that end there; token ``t`` is the right one if
the prefix before it ends in a token ``u`` such that BPE keeps ``u`` and ``t``
apart.  That is tested on the two tokens alone: unwind their merges, latest
first, and see whether an earlier merge would have joined the pieces that meet
at the border.  Following the stored tokens backwards gives the ids, in time
linear in the word, whatever its length.

Words come from the tokenizer's own splitting pattern and repeat a lot, so a
worker keeps the ids of up to ``CACHE_WORDS`` short words.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import packed, unpacked

#: Words kept per worker process, none longer than CACHE_CHARS.  They stand in two generations of half the size:
#: when the young one is full it becomes the old one, and what is asked for again moves back to the young one.
CACHE_WORDS = 400_000
CACHE_CHARS = 64
#: The splitting pattern of byte-level tokenizers (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Outcomes of the border test kept per worker process, emptied when full.
CACHE_PAIRS = 300_000


def byte_letters() -> dict[int, str]:
    """The printable letter that a vocabulary file writes for each byte: itself where printable, else the next from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class Bpe:
    """Vocabulary, merges and automaton of one tokenizer file."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as source:
            model = json.load(source)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        vocab = {bytes(byte_of[c] for c in token): no for token, no in model["model"]["vocab"].items() if all(c in byte_of for c in token)}
        added = {t["content"]: t["id"] for t in model.get("added_tokens") or []}
        self.added = added
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(PATTERN)
        self.bytes_of = {no: token for token, no in vocab.items()} | {no: text.encode() for text, no in added.items()}
        self.byte_ids = [vocab[bytes([b])] for b in range(256)]
        #: (left, right) -> (rank, merged token)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        #: merged token -> (rank, left, right), of its first merge
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = (bytes(byte_of[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.merge[a, b] = (rank, whole)
            self.made.setdefault(whole, (rank, a, b))
        # A merged token that BPE never reaches from its own bytes can't end a prefix.
        reached = {no for no in self.byte_ids}
        for no, (rank, a, b) in sorted(self.made.items(), key=lambda item: item[1][0]):
            if a in reached and b in reached and self.apart(a, b, rank):
                reached.add(no)
        self.automaton = ahocorasick.Automaton()
        for token, no in vocab.items():
            if no in reached:
                self.automaton.add_word(token.decode("latin-1"), (len(token), no))
        self.automaton.make_automaton()
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.tested: dict[tuple[int, int], bool] = {}

    def apart(self, left: int, right: int, below: int = 1 << 60) -> bool:
        """No merge of a rank under ``below`` joins the two tokens when both are built up by BPE side by side."""
        merge, made = self.merge, self.made
        atom = (-1, -1, -1)
        while True:
            joined = merge.get((left, right))
            if joined is not None and joined[0] < below:
                return False
            from_left, from_right = made.get(left, atom), made.get(right, atom)
            # Undo the later of the two last merges: before it, the border was between the smaller pieces,
            # and a merge across it happened only if its rank comes before.  On the same rank the left one goes first.
            if from_left[0] < 0 and from_right[0] < 0:
                return True
            if from_left[0] > from_right[0]:
                below, left = min(below, from_left[0]), from_left[2]
            else:
                below, right = min(below, from_right[0] + 1), from_right[1]

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word by the last tokens of its prefixes."""
        size = len(word)
        last = [-1] * (size + 1)
        width = [0] * (size + 1)
        tested = self.tested
        if len(tested) > CACHE_PAIRS:
            tested.clear()
        for end, (length, no) in self.automaton.iter(word.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            before = last[start]
            if start:
                if before < 0:
                    continue
                fits = tested.get((before, no))
                if fits is None:
                    fits = tested[before, no] = self.apart(before, no)
                if not fits:
                    continue
            last[end], width[end] = no, length
        ids, at = [], size
        while at > 0:
            if last[at] < 0:
                raise ValueError("the vocabulary doesn't cover this word")
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        parts = self.added_split.split(text) if self.added_split else [text]
        known = self.known
        for no, part in enumerate(parts):
            if no % 2:
                ids.append(self.added[part])
                continue
            for word in self.words.findall(part):
                found = known.get(word)
                if found is None:
                    found = self.older.get(word)
                    if found is None:
                        found = tuple(self.encode_word(word.encode("utf-8")))
                    if len(word) <= CACHE_CHARS:
                        if len(known) >= CACHE_WORDS // 2:
                            self.older, self.known = known, {}
                            known = self.known
                        known[word] = found
                ids.extend(found)
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def loaded(file: str) -> Bpe:
    """One tokenizer per worker process."""
    return Bpe(file)


def encode(docs: DataFrame, file: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """All rows and columns plus n_tokens, ids_sha256 and decoded_sha256, and with ``with_ids`` the token_ids.

    Null text counts as empty: no ids, digests of nothing.  Strings of added
    tokens in a text become their ids.  Rows are independent: repeated rows get
    equal results.  Input columns named like an output are replaced.  ``file``
    must be readable where the tasks run.
    """
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + (",token_ids:array<int>>" if with_ids else ">")

    @F.pandas_udf(kind)
    def digest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = loaded(file)
        for batch in texts:
            rows = []
            for value in batch:
                ids = bpe.encode(value or "")
                packed_ids = np.asarray(ids, dtype="<u4")
                row = (len(ids), hashlib.sha256(packed_ids.tobytes()).hexdigest(), hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
                rows.append((*row, ids) if with_ids else row)
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * with_ids])

    made = ["n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * with_ids]
    done = packed(docs, _text=F.col(f"`{text}`")).withColumn("_made", digest("_text"))
    return unpacked(done.select("_row", "_made.*"), docs.columns, *made)
