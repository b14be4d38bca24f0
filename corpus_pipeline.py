"""A corpus from raw documents to packed sequences: five stages, each an operator over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearken.llm import exact_dedup, jaccard_join, language, packing, substring_dedup
from hearken.llm.common import read_documents, saved


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; null texts and texts without letters go."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    return language.keep_known(docs, language.fit(docs, learn))


def _bytes():
    return F.coalesce(F.col("text").cast("binary"), F.lit(b""))


def _own(docs: DataFrame, chosen: DataFrame, key: str, of_text) -> DataFrame:
    """The rows of `docs` whose doc_id, null or not, and text's key are in `chosen` (doc_id, key); of rows that agree in both, one."""
    own = "".join(docs.columns) + "_key"
    chosen = chosen.select("doc_id", key).toDF(own + "_id", own + "_chosen")
    kept = docs.withColumn(own, of_text).join(chosen, F.col("doc_id").eqNullSafe(F.col(own + "_id")) & (F.col(own) == F.col(own + "_chosen")), "left_semi")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.select(docs.columns)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id, one without doc_id if none has any; of rows that repeat it, one. A row
    is decided by its own text, even if another has the same doc_id."""
    groups = exact_dedup.exact_groups(docs, keep="largest")
    return _own(docs, groups.where("kept").select("doc_id", "text_sha256"), "text_sha256", F.sha2(_bytes(), 256))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id, one without doc_id if none has any; if the
    group has several texts of that doc_id, one of them; of rows that repeat it, one. Null texts and texts without words
    stay; a row is decided by its own text, even if another has the same doc_id."""
    return _own(docs, jaccard_join.representatives(docs), "text_key", jaccard_join.text_key(_bytes()))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in earlier documents; untouched texts keep their white space. Null texts stay
    null; a text may become empty; rows without doc_id keep theirs whole and cut nothing; rows that share a doc_id are cut
    each by itself."""
    return substring_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: the pieces of every row, with their places. A null or empty text is its end id
    alone; rows that repeat, or have no doc_id, are packed one by one."""
    return packing.pack(packing.pieces(docs, _vocabulary()))


STAGES = [("language ID", identify), ("exact dedup", unique), ("n-gram Jaccard join", distinct), ("substring dedup", passages), ("best-fit packing", pack)]

#: SQL can express neither the classifier of the first stage nor the packing of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
