"""OCR results: a graph of blocks (image_key, pos, Id, BlockType, Text, EntityTypes, Relationships) becomes lines, pairs
and counts. An image's graph is one row, walked within it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import image_ids


def lines(blocks: DataFrame) -> DataFrame:
    """image_key, lines, full_text in reading order."""
    own = blocks.where("BlockType = 'LINE' and Text is not null").groupBy("image_key").agg(F.array_sort(F.collect_list(F.struct("pos", "Text"))).alias("l"))
    texts = F.transform("l", lambda x: x["Text"])
    return own.select("image_key", texts.alias("lines"), F.array_join(texts, "\n").alias("full_text"))


def _graphs(blocks: DataFrame) -> DataFrame:
    """image_key, words (text of each word by its id), children (ids below each block by its id), keys (pos, id and value's id
    of each labelled key): an image's whole graph in a row, after one exchange by image. Of blocks of one id the last
    counts."""
    own = blocks.select("image_key", "pos", "Id", "BlockType", "Text", "EntityTypes", "Relationships").repartition("image_key")
    last = own.groupBy("image_key", "Id").agg(F.max_by(F.struct("pos", "BlockType", "Text", "EntityTypes", "Relationships"), "pos").alias("b"))
    related = lambda kind: F.filter(F.coalesce("b.Relationships", F.array()), lambda r: (r["Type"] == kind) & (F.size(r["Ids"]) > 0))
    word = F.col("b.BlockType").isin("WORD", "SELECTION_ELEMENT") & (F.col("b.Text") != "")
    below = F.flatten(F.transform(related("CHILD"), lambda r: r["Ids"]))
    value = F.try_element_at(related("VALUE"), F.lit(-1))["Ids"][0]
    key = (F.col("b.BlockType") == "KEY_VALUE_SET") & F.array_contains("b.EntityTypes", "KEY")
    gathered = lambda condition, *fields: F.collect_list(F.when(condition, F.struct(*fields)))
    return last.where("Id is not null").groupBy("image_key").agg(
        F.map_from_entries(gathered(word, "Id", "b.Text")).alias("words"),
        F.map_from_entries(gathered(F.size(below) > 0, "Id", below.alias("ids"))).alias("children"),
        gathered(key, F.col("b.pos").alias("pos"), "Id", value.alias("target")).alias("keys"),
    )


def _text_below(id_: Column) -> Column:
    """The words below a block, joined; null if there are none."""
    ids = F.coalesce(F.try_element_at(F.col("children"), id_), F.array().cast("array<string>"))
    said = F.array_compact(F.transform(ids, lambda i: F.try_element_at(F.col("words"), i)))
    return F.nullif(F.array_join(said, " "), F.lit(""))


def block_texts(blocks: DataFrame) -> DataFrame:
    """image_key, Id, text: the words below each block that has any."""
    told = _graphs(blocks).select("image_key", F.explode(F.transform(F.map_keys("children"), lambda i: F.struct(i.alias("Id"), _text_below(i).alias("text")))).alias("t"))
    return told.select("image_key", "t.Id", "t.text").where("text is not null")


def key_values(blocks: DataFrame) -> DataFrame:
    """image_key, key, value of each labelled pair; of a repeated key the last value stays, and a key without a value has
    an empty one."""
    pair = lambda k: F.struct(k["pos"].alias("pos"), _text_below(k["Id"]).alias("key"), F.coalesce(_text_below(k["target"]), F.lit("")).alias("value"))
    pairs = _graphs(blocks).select("image_key", F.explode(F.transform("keys", pair)).alias("p")).where("p.key is not null")
    tidy = pairs.select("image_key", "p.pos", F.trim(F.regexp_replace("p.key", ":+$", "")).alias("key"), "p.value").where("key <> ''")
    return tidy.groupBy("image_key", "key").agg(F.max_by("value", "pos").alias("value"))


def block_counts(blocks: DataFrame) -> DataFrame:
    """image_key, BlockType, n."""
    return blocks.groupBy("image_key", "BlockType").agg(F.count("*").alias("n"))


def image_records(blocks: DataFrame) -> DataFrame:
    """image_key, full_text, lines, textract_key_values, metadata, block_counts of each image."""
    told = blocks.select("image_key").distinct().join(lines(blocks), "image_key", "left")
    pairs = key_values(blocks).groupBy("image_key").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("textract_key_values"))
    counts = block_counts(blocks).groupBy("image_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("BlockType", F.col("n").cast("int"))))).alias("block_counts"))
    return told.join(pairs, "image_key", "left").join(counts, "image_key", "left").select(
        "image_key", F.coalesce("full_text", F.lit("")).alias("full_text"), F.coalesce("lines", F.array().cast("array<string>")).alias("lines"),
        F.coalesce("textract_key_values", F.create_map().cast("map<string,string>")).alias("textract_key_values"), image_ids(F.col("image_key")).alias("metadata"), "block_counts",
    )


def ids_agree(records: DataFrame) -> DataFrame:
    """Whether the ids that a file's name tells stand in its text."""
    told = lambda c: (F.col(f"metadata.{c}") != "") & F.contains("full_text", F.col(f"metadata.{c}"))
    return records.select("image_key", told("product_id").alias("product_agrees"), told("customer_id").alias("customer_agrees"))
