"""The corpus pipeline: documents through the stages, each stage's rows stored before the next reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursegrain.llm import bpe, mixing, quality, secrets, setjoin
from coursegrain.llm.base import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.

    It learns from the labelled documents of its input that are not held out.
    Null and empty texts get the score of a text without known words.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    plain = docs.drop("score", "predicted")
    return quality.score(plain, model).filter("predicted = 1").select(*plain.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; blank texts stay."""
    return setjoin.distinct_documents(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret that the scan reports is masked in the text; no document goes."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes; the document on a source's cut keeps its leading words."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens and digests of the ids and of the text they decode to."""
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(docs.select("doc_id", "text"), file).drop("text")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: Learned and iterative stages have no SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over all before it, from the table ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}")
    return docs
