"""Secret scan with multipart credential linking.

Base spans are found with regular expressions inside the row that holds the
text.  Weak parts (a bare 40-character key, an endpoint) are common in clean
text, so they count only next to complementary parts: a bare key within
``SCOPE`` code points of an access identifier, an endpoint within ``SCOPE`` of an
access identifier and of a secret (an assigned one or a linked bare key).  The
linking is an interval join by sorted sweep: the parts of one text are ordered by
start and each meets the nearest earlier and later part of each kind, so the work
is linear in the parts and no pair is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import packed, replaced, unpacked

# Fixed values of the base scan.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS_MARK = "AKIA"
ACCESS = rf"{ACCESS_MARK}[A-Z0-9]+"
ACCESS_LEAST = 18
HEX = r"[0-9a-f]+"
HEX_LEAST = 16

#: A failing access or hex match ends where its run of characters ends, so the least length can stand in the pattern.
ACCESS_LONG = rf"{ACCESS_MARK}[A-Z0-9]{{{ACCESS_LEAST - 4},}}"
HEX_LONG = rf"[0-9a-f]{{{HEX_LEAST},}}"
BARE_KEY = r"(?<![A-Za-z0-9/+=_-])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=_-])"
ENDPOINT = r"""https?://[^\s"'<>]+"""

SCOPE = 400
#: Kinds in report order; the first three are the base scan.
KINDS = ("assign", "access", "hex", "bare_key", "endpoint")
MASK = "[SECRET]"

_SPAN = "array<struct<s:bigint,e:bigint>>"


def _blocks(items: Column) -> Column:
    """The items in about as many blocks as a block has items, so that a fold that appends copies little."""
    wide = F.ceil(F.sqrt(F.size(items))).cast("int")
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / wide).cast("int")), lambda no: F.slice(items, no * wide + 1, wide))


def _lengths(text: Column, pattern: str, hits: Column, keep=None) -> Column:
    """Per hit: the length of the piece before it, its own, and whether it counts."""
    return F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits,
        lambda piece, hit: F.struct(F.length(piece).cast("long").alias("gap"), F.length(hit).cast("long").alias("len"), (keep(hit) if keep else F.lit(True)).alias("ok")),
    )


def _spans(lengths: Column) -> Column:
    """Start and end of every hit that counts, in code points: inside each block first, then with the blocks' own starts."""

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["len"]
        span = F.array(F.struct(start.alias("s"), end.alias("e")))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(state["out"], span)).otherwise(state["out"]).alias("out"))

    def shifted(state: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda x: F.struct((x["s"] + state["at"]).alias("s"), (x["e"] + state["at"]).alias("e")))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))
    inside = F.transform(_blocks(lengths), lambda block: F.aggregate(block, begin, step))
    whole = F.aggregate(inside, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out")), shifted)
    return F.when(F.size(lengths) > 0, F.flatten(whole["out"])).otherwise(F.array().cast(_SPAN))


def _parts(docs: DataFrame, text: Column, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``docs`` plus one array of spans per kind; those of kinds not asked for are empty."""
    patterns = {k: p for k, p in zip(KINDS, (ASSIGN, ACCESS_LONG, HEX_LONG, BARE_KEY, ENDPOINT), strict=True) if k in kinds}
    found = docs.withColumns({f"_h_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    long_value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_LEAST
    # A column of its own: a lambda would work out an expression again for every block.
    found = found.withColumns({f"_l_{k}": _lengths(text, p, F.col(f"_h_{k}"), long_value if k == "assign" else None) for k, p in patterns.items()})
    spans = {f"_s_{k}": _spans(F.col(f"_l_{k}")) for k in patterns}
    spans |= {f"_s_{k}": F.array().cast(_SPAN) for k in KINDS if k not in kinds}
    return found.withColumns(spans).drop(*[f"_{x}_{k}" for x in "hl" for k in patterns])


def _labelled(kind: str, label: Column) -> Column:
    return F.transform(f"_s_{kind}", lambda x: F.struct(label, x["s"].alias("s"), x["e"].alias("e")))


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """(_key) -> the weak spans that complementary parts support.  Texts without an access identifier drop out at once."""
    able = parts.filter((F.size("_s_access") > 0) & (F.size("_s_bare_key") + F.size("_s_endpoint") > 0)).dropDuplicates(["_key"])
    each = F.flatten(F.array(*[_labelled(k, F.lit(k).alias("kind")) for k in ("assign", "access", "bare_key", "endpoint")]))
    rows = able.select("_key", F.inline(each))
    order = W.partitionBy("_key").orderBy("s", "e", "kind")
    earlier, later = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)

    def near(is_part: Column) -> Column:
        """A part of this kind starts or ends within the scope."""
        back = F.col("s") - F.max(F.when(is_part, F.col("e"))).over(earlier)
        ahead = F.min(F.when(is_part, F.col("s"))).over(later) - F.col("e")
        return F.coalesce(back <= scope, F.lit(False)) | F.coalesce(ahead <= scope, F.lit(False))

    kind = F.col("kind")
    rows = rows.withColumn("_id_near", near(kind == "access"))
    rows = rows.withColumn("_secret", (kind == "assign") | ((kind == "bare_key") & F.col("_id_near")))
    rows = rows.withColumn("_secret_near", near(F.col("_secret")))
    sound = ((kind == "bare_key") & F.col("_id_near")) | ((kind == "endpoint") & F.col("_id_near") & F.col("_secret_near"))
    return rows.filter(sound).groupBy("_key").agg(F.collect_list(F.struct("kind", "s", "e")).alias("_linked"))


def _ranked(kind: str) -> Column:
    return F.transform(f"_s_{kind}", lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e")))


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """All rows and columns plus n_assign, n_access, n_hex, base_spans and spans.

    The span columns are arrays of (kind, s, e): code points, end exclusive, by
    start and then in the order of ``KINDS``.  Null or empty text has no spans.
    Linking runs per distinct text, so repeated rows and null ids get the same
    result.  Texts without the mark of an access identifier can't link anything:
    they stay where they are, only the others are joined with their links.
    Time grows with the number of hits in a text to the power of 1.5.
    Input columns named like an output are replaced.
    """
    rows = packed(docs, _text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    marked = F.contains(F.col("_text"), F.lit(ACCESS_MARK))
    parts = _parts(rows.filter(marked).withColumn("_key", F.sha2(F.col("_text").cast("binary"), 256)), F.col("_text"))
    linked = _linked(parts, scope).withColumnRenamed("_key", "_linked_key")
    joined = parts.join(linked, F.col("_key") == F.col("_linked_key"), "left").drop("_key", "_linked_key")
    joined = joined.unionByName(_parts(rows.filter(~marked), F.col("_text"), ("assign", "hex")), allowMissingColumns=True)
    name = lambda k: F.lit(KINDS.index(k))
    rank = lambda kinds: F.flatten(F.array(*[_ranked(k) for k in kinds]))
    weak = F.transform(F.col("_linked"), lambda x: F.struct(x["s"].alias("s"), F.when(x["kind"] == KINDS[3], name(KINDS[3])).otherwise(name(KINDS[4])).alias("k"), x["e"].alias("e")))
    labelled = lambda spans: F.transform(F.array_sort(spans), lambda x: F.struct(F.get(F.array(*map(F.lit, KINDS)), x["k"]).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    base = rank(KINDS[:3])
    result = joined.withColumns({
        "n_assign": F.size("_s_assign").cast("long"), "n_access": F.size("_s_access").cast("long"), "n_hex": F.size("_s_hex").cast("long"),
        "base_spans": labelled(base), "spans": labelled(F.when(F.col("_linked").isNull(), base).otherwise(F.concat(base, weak))),
    })
    return unpacked(result, docs.columns, "n_assign", "n_access", "n_hex", "base_spans", "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` items joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", mask: str = MASK) -> DataFrame:
    """The rows of ``docs`` with every span, overlapping ones together, replaced by ``mask``.

    Spans are worked through in blocks, each on the part of the text from the last
    end before it (a position is found by reading up to it) to its own last start.
    """
    found = scan(packed(docs, text=F.col(f"`{text}`")), "text")
    least = F.lit(0).cast("long")
    blocks = F.transform(_blocks(F.col("spans")), lambda b: F.struct(b.alias("spans"), F.element_at(b, -1)["s"].alias("last"), F.array_max(F.transform(b, lambda x: x["e"])).alias("end")))
    carried = F.aggregate(
        blocks, F.struct(least.alias("end"), F.array().cast("array<struct<begin:bigint,last:bigint,spans:array<struct<kind:string,s:bigint,e:bigint>>>>").alias("out")),
        lambda state, b: F.struct(
            F.greatest(state["end"], b["end"]).alias("end"), F.concat(state["out"], F.array(F.struct(state["end"].alias("begin"), b["last"].alias("last"), b["spans"].alias("spans")))).alias("out")),
    )
    piece = lambda whole, begin, end: F.substring(whole, (begin + 1).cast("int"), F.greatest(end - begin, least).cast("int"))
    cut = F.transform("_fold.out", lambda b: F.struct(b["begin"].alias("begin"), piece(F.col("text"), b["begin"], b["last"]).alias("part"), b["spans"].alias("spans")))

    def masked(block: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            gap = piece(block["part"], state["at"] - block["begin"], x["s"] - block["begin"])
            apart = F.struct(x["e"].alias("at"), F.concat(state["out"], F.array(F.concat(gap, F.lit(mask)))).alias("out"))
            joined = F.struct(F.greatest(x["e"], state["at"]).alias("at"), state["out"].alias("out"))
            return F.when(x["s"] < state["at"], joined).otherwise(apart)

        begin = F.struct(block["begin"].alias("at"), F.array().cast("array<string>").alias("out"))
        return F.array_join(F.aggregate(block["spans"], begin, step)["out"], "")

    folded = found.withColumn("_fold", F.when(F.size("spans") > 0, carried))
    tail = F.substring("text", (F.col("_fold.end") + 1).cast("int"), F.lit(2**31 - 1))
    clean = F.when(F.col("_fold").isNotNull(), F.concat(F.array_join(F.transform(cut, masked), ""), tail)).otherwise(F.col("text"))
    return replaced(folded.withColumn("text", clean), docs, text, n_chars)
