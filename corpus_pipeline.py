"""Documents to training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.llm.common import saved, table
from crmtide.llm.mixing import mix, words
from crmtide.llm.near_dedup import near_duplicates
from crmtide.llm.packing import pack_documents
from crmtide.llm.substring_dedup import remove_passages
from crmtide.llm.toxicity import score_toxicity


def _apart(docs: DataFrame, *columns) -> DataFrame:
    """Whole rows as ``row`` beside the columns an operator reads, so that no other column can meet its names."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the classifier learns from the labels of these documents.

    NULL and empty texts get the score of the bias. Rows without id are scored
    too, repeated rows alike; a long text is scored whole. All columns are kept,
    whatever their names. An empty table gives no rows.
    """
    scored = score_toxicity(_apart(docs, "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.filter("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id, then the smallest hash of its text.

    A row is known by its id and its text, so texts that share an id are judged
    one by one. Of rows that are equal in both, one stays, with the least of
    their other columns. Rows without id stay, all of them; NULL texts and texts
    without words are like no other and stay. Long texts are compared whole. All
    columns are kept, whatever their names. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = _apart(docs.filter("doc_id is not null"), F.xxhash64("doc_id", F.col("text").isNull(), text).alias("name"))
    named = rows.groupBy("name").agg(F.min("row").alias("row"))
    found = near_duplicates(rows.select("name", F.col("row.text").alias("text")), "name")
    linked = found.join(found.filter("not kept").select("component_id").distinct(), "component_id", "left_semi")
    own = rows.select("name", F.col("row.doc_id").alias("id")).join(linked.select("name", "component_id"), "name")
    first = own.groupBy("component_id").agg(F.min(F.struct("id", "name")).alias("first"))
    gone = own.join(first, "component_id").filter("name <> first.name").select("name").distinct()
    kept = named.join(gone, "name", "left_anti").select("row.*")
    return kept.unionByName(docs.filter("doc_id is null"))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; a text of which nothing is left goes.

    Rows without id, with a NULL or an empty text stay as they are. Rows that
    repeat an id count as one document, each loses its own passages. Long texts
    are compared whole. All columns are kept; ``n_chars`` follows the text. An
    empty table gives no rows.
    """
    return remove_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it: not at all, once or twice.

    A NULL source is a source of its own. NULL, empty and wordless texts have size
    0 and go where their source's turn is. Rows with a NULL or repeated id and
    equal rows are rows like others; a long text counts all its words. All
    columns are kept, whatever their names. An empty table gives no rows.
    """
    sized = _apart(docs, "doc_id", "source", words("text").alias("size"))
    mixed = mix(sized).filter("times > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place in it; see ``packing.pack_documents``.

    A NULL or empty text is one id long. Rows with a NULL or repeated id and equal
    rows are packed like others; a long text is cut into pieces. Other columns are
    left out. An empty table gives no rows.
    """
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier, sketches and a greedy packing are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
