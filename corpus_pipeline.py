"""Pipeline from raw documents to encoded training texts.

Each stage takes (spark, documents, folder of the tables) and works on all that its
predecessor kept; all but the last return the columns of ``documents``, whatever else the
table carries. Decisions reach the rows by a 64-bit hash of what they rest on (doc_id and text,
for the quality rules the language too), so rows that share an id, or have none, are decided
each by its own text, and rows that are equal in these columns alike. Null ids and texts are
values like others; empty tables give empty results. A stage begins with what its predecessor
no longer needs given back: heap and Python workers share an executor's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tachoflow.llm.decontamination import contaminated
from tachoflow.llm.jaccard_join import jaccard_components
from tachoflow.llm.personal_data import personal_data, redacted
from tachoflow.llm.quality_rules import quality_report
from tachoflow.llm.sentencepiece_codec import encoded
from tachoflow.llm.tables import broadcast_if_small, release, small_batches, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Hash of what a decision rests on.
KEY = "_decided_by"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text", *more))


def _by_key(keyed: DataFrame, *columns: str) -> DataFrame:
    """The rows as an operator reads them, with the key in the place of the id."""
    return keyed.select(F.col(KEY).alias("doc_id"), *columns)


def _without(keyed: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose key isn't among the rejected ones (column KEY)."""
    keys = broadcast_if_small(written(rejected.distinct(), "rejected"), 32)
    return keyed.join(keys, KEY, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their language's perplexity band keep.

    A text that is null, empty or short goes. Repeated rows stay or go together.
    """
    release(spark)
    keyed = _keyed(_documents(docs), "lang")
    with small_batches(spark):
        report = quality_report(_by_key(keyed, "text", "lang"))
    return _without(keyed, report.where("not kept").select(F.col("doc_id").alias(KEY))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group with alike 5-word shingles (0.8 or more): that of the smallest id.

    A row without an id stays only where no row of its group has one. Of several rows with the
    id and text that stay, the one smallest in the other columns does. Texts without words are
    linked with nothing, so all of them stay.
    """
    release(spark)
    keyed = _keyed(_documents(docs))
    groups = written(jaccard_components(_by_key(keyed, "text"), size=5, percent=80), "groups")
    groups = groups.where("n_shingles > 0").groupBy(F.col("doc_id").alias(KEY), "component_id").agg(F.count("*").alias("n"))
    shared = groups.groupBy("component_id").agg(F.sum("n").alias("rows")).where("rows > 1").select("component_id")
    several = written(groups.join(shared, "component_id"), "several")
    ids = keyed.join(broadcast_if_small(several.select(KEY, "component_id"), 32), KEY).select(KEY, "component_id", "doc_id").distinct()
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", KEY))[KEY].alias("first"))
    decided = written(several.join(first, "component_id").select(KEY, "n", (F.col(KEY) == F.col("first")).alias("stays")), "decided")
    kept = _without(keyed, decided.where("not stays").select(KEY))
    again = broadcast_if_small(decided.where("stays and n > 1").select(KEY), 32)
    one = kept.join(again, KEY, "left_semi").groupBy(KEY).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return kept.join(again, KEY, "left_anti").select(*COLUMNS).unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Texts without words hold none; repeated rows stay or go together."""
    release(spark)
    keyed = _keyed(_documents(docs))
    found = contaminated(_by_key(keyed, "text"), table(spark, sf_dir, "benchmark"))
    with small_batches(spark):
        return _without(keyed, found.select(F.col("doc_id").alias(KEY))).select(*COLUMNS)


def personal_data_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    A null text stays null; repeated rows come out alike.
    """
    release(spark)
    docs = _documents(docs)
    out = redacted(docs, personal_data(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document; a null text has null ids, repeated rows come out alike."""
    release(spark)
    return encoded(_documents(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data_redaction),
    ("SentencePiece encoding", sentencepiece),
]

#: The perplexity bands and the boosted trees of two stages aren't SQL; tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").replace(".", ""))
    return STAGES[-1][1](spark, docs, sf_dir)
