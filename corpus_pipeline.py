"""A training corpus from raw documents: language ID, line dedup, near-dedup, suffix dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
all but the last return the columns of documents.  Stages:

- language_id learns from the documents with a known language and drops those it
  rejects: texts that are null or have no letter.  A missing language is filled in.
- line_dedup removes repeated multi-line chunks; documents that consist of nothing
  else are copies and go.
- near_dedup keeps the document of least id of each group whose SimHash fingerprints
  are within two bits (op3's, by its ball hashing) or whose sets of five-word shingles
  are at least 0.8 similar.
- suffix_dedup removes bytes in 50-byte strings of earlier documents; code points
  cut by that go as a whole, and documents of which nothing is left go.
- packing puts the tokens of what is left into sequences of 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import best_fit_packing, language_id, line_dedup, simhash, suffix_dedup
from gleaner.llm.common import cut


def _whole(docs: DataFrame, new: tuple[str, ...] = ()) -> DataFrame:
    """What an operator reads, and beside it the row but for columns that get new values: none can clash with the operator's own."""
    return docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in new]).alias("_row"))


def _columns(out: DataFrame, columns: list[str], **new) -> DataFrame:
    """docs' columns again, some of them with a new value."""
    return out.select(*[(new[c] if c in new else F.col(f"_row.`{c}`")).alias(c) for c in columns])


def _changed(out: DataFrame, columns: list[str]) -> DataFrame:
    """docs' columns with the text as it now is, and its length."""
    return _columns(out, columns, text=F.col("text"), n_chars=F.length("text").cast("long"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    out = language_id.predict(_whole(docs), model, carry=("_row",))
    return _columns(out.filter("lang_pred <> 'und'"), docs.columns, lang=F.coalesce("_row.lang", "lang_pred"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_whole(docs, ("text", "n_chars")))
    return _changed(out.filter("n_removed_lines = 0 or length(text) > 0"), docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs).select(*docs.columns)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(_whole(docs, ("text", "n_chars")), carry=("_row",)).withColumn("text", suffix_dedup.kept_text("kept"))
    return _changed(out.filter("n_removed = 0 or length(text) > 0"), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]

#: Several stages cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
