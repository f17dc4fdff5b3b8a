"""From raw documents to training data: five stages, each on all that the one before kept.

Every stage takes the session, the documents and the folder of the tables. All but the last return
the columns of ``documents``; the last adds the piece ids. SQL cannot express the stages; tests
compare each with a brute-force version on its own input.

All stages take null ids, texts and sources, repeated rows, texts of any length, other columns of any
name and an empty table, which gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import jaccard, mixing, personal, pieces, quality
from orderloom.llm.common import columns_of, fresh, saved, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5).

    Null and empty texts are scored as empty; equal texts have equal scores, so copies stay or go
    together.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "score")
    return quality.score(docs, model, out=score).where(F.col(score) >= 0.5).select(
        *columns_of(docs)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles.

    The smallest id of a group stays; where ids are missing or repeat, the first row. Texts without
    words, null ones too, all stay.
    """
    return jaccard.distinct_documents(docs, width=5, num=80, den=100)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows.

    Null texts stay null; no row goes, however often it repeats.
    """
    masked = personal.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast("long"))
    return masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: left out, once, or repeated.

    A null source is a source of its own. Texts without words weigh nothing: they stay as often as
    the documents their source takes in full.
    """
    whole = docs.select("doc_id", "text", "source", F.struct(*columns_of(docs)).alias("document"))
    mixed = mixing.mix(whole, carry=["document"])
    turns = F.sequence(F.lit(1).cast("long"), F.col("times"))
    return mixed.where("times > 0").select("document", F.explode(turns)).select("document.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids; null and empty texts have none."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("personal data", mask_personal_data),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

# No stage but the masks of strict spans could be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
