"""A corpus pipeline of five operators: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's documents.

Edge cases, of all stages: extra columns pass through all stages but the last,
whatever their names; repeated rows and ids are rows of their own, except that
near_dedup keeps all rows of the id that stays, and decontaminate drops all
rows of an id that holds a benchmark item; an empty table gives an empty
result.  A null or empty text, or one without letters, is rejected by the first
stage; the others keep such a row (line_dedup and near_dedup unchanged, the mix
as size 0).  A null id is kept where its row is not rejected: it is the
smallest of no group and matches no item.  Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm import decontam, langid, line_dedup, minhash, mixing
from cairnspark.llm.shared import cut, without


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (null, empty or letterless texts) and those that are no language's by a third of their words."""
    model = langid.train(docs.select("doc_id", "text", "lang"), F.lit(True))
    return langid.keep_identified(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of recurring templates; a document that loses its last non-blank line goes."""
    kept, before, after = names = ("_cairn_kept", "_cairn_before", "_cairn_after")
    cleaned = line_dedup.drop_lines(docs, line_dedup.recurring(docs), names=names)
    same = F.col(before) == F.col(after)
    cleaned = cleaned.where(same | F.col(kept).rlike("\\S"))
    changed = {"text": F.col(kept), "n_chars": F.when(same, F.col("n_chars")).otherwise(F.length(kept))}
    return cleaned.select(*[changed[c].cast(t).alias(c) if c in changed else F.col(c) for c, t in docs.dtypes])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    groups = cut(minhash.near_duplicates(docs), "groups")
    return without(docs, groups.where("not kept").select("doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with questions or passages of the benchmark go."""
    hits = decontam.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, hits.select("doc_id").distinct())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their number of copies and the words they give."""
    m = mixing.mix_sources(spark, docs).where("copies > 0")
    return m.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
]

#: SQL can't express the model of the first stage.  tests/llm compare the rows of run(): each stage's with what a plain Python
#: version (line_dedup, near_dedup, targets of mix_sources) or the operator's own verdicts (language_id, decontaminate) give.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
