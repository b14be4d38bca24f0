"""Column functions against small independent Python models."""

import random

import pytest
from pyspark.sql import functions as F

from hearken.functions import text as T
from hearken.functions import values as V
from hearken.operators import calls


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


def many(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", f(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows)]


def test_truncation_ends_between_characters(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aé日🙂") for _ in range(rng.randrange(0, 20))) for _ in range(200)]
    for limit in (1, 5, 12):
        assert many(spark, texts, lambda c: T.truncate_bytes(c, limit)) == [t.encode()[:limit].decode("utf-8", "ignore") for t in texts]


@pytest.mark.parametrize("text,ref", [("Order #ORD-9001", "ORD-9001"), ("it's order 9001.", "ORD-9001"), ("ord 123 and order 456", "ORD-123"), ("order number 77777", "ORD-77777"), ("order 12", None), ("disorder 9001", None), ("", None), (None, None)])
def test_order_ref(spark, text, ref):
    assert one(spark, text, T.order_ref) == ref


def test_names_and_keys(spark):
    keys = ["a.b/c/call_001.mp3", "plain", "x/.hidden", "x/two.dots.PNG", "raw-data/images/EAR-2200_CUST-2001.png", ""]
    assert many(spark, keys, T.stem) == ["call_001", "plain", ".hidden", "two.dots", "EAR-2200_CUST-2001", ""]
    assert many(spark, keys, T.extension) == ["mp3", "", "", "png", "png", ""]
    assert many(spark, ["a.mp3", "a.M4A", "a.txt", "a"], T.media_format) == ["mp3", "m4a", None, None]
    assert one(spark, "processed-data/reviews/r_1_processed.json", T.document_stem) == "r_1"
    assert one(spark, "validation-results/reviews/r_1_validation.json", T.validation_to_raw_key) == "raw-data/reviews/r_1.json"
    assert one(spark, "raw-data/reviews/r_1.json", T.raw_to_validation_key) == "validation-results/reviews/r_1_validation.json"
    assert one(spark, "validation-results/reviews/r_1_validation.json", T.validation_to_processed_key) == "processed-data/reviews/r_1_processed.json"
    assert one(spark, "raw-data/images/EAR-2200_CUST-2001.png", T.image_to_processed_key) == "processed-data/images/EAR-2200_CUST-2001_processed.json"
    assert one(spark, "raw-data/calls/c 1.mp3", lambda c: T.staged_key(c, "transcriptions/", ".json")) == "transcriptions/c 1.json"
    assert one(spark, "x/EAR-2200_CUST-2001.png", T.image_ids).asDict() == {"product_id": "EAR-2200", "customer_id": "CUST-2001"}
    assert one(spark, "x/holiday.png", T.image_ids).asDict() == {"product_id": "", "customer_id": ""}


def test_job_name(spark):
    now = F.timestamp_seconds(F.lit(1789985700))
    name = one(spark, "raw/my call (final).mp3", lambda c: T.job_name(c, now))
    assert name.startswith("feedback-my-call--final--2026") and len(one(spark, "x" * 400 + ".mp3", lambda c: T.job_name(c, now))) == 200


@pytest.mark.parametrize("uri", ["s3://my_bucket/a/b%20c+d.json", "https://s3.us-east-1.amazonaws.com/my_bucket/a/b%20c+d.json", "https://my_bucket.s3.us-east-1.amazonaws.com/a/b%20c+d.json"])
def test_object_address(spark, uri):
    assert one(spark, uri, T.object_address).asDict() == {"bucket": "my_bucket", "key": "a/b c+d.json"}


def test_event_keys(spark):
    assert one(spark, "my+call+001%282%29.mp3", T.decode_event_key) == "my call 001(2).mp3"


def test_safe_identifiers(spark):
    assert many(spark, ["EAR-2200", "ear-2200", " CUST-1 ", "cust-9", "ord-12", "ORD-x", "John"], T.is_safe_identifier) == [True, False, True, True, True, False, False]


def test_redaction_from_the_back(spark):
    spans = "array<struct<Type:string,BeginOffset:int,EndOffset:int>>"
    row = spark.createDataFrame([("call 🙂 Ann at 555", [("PHONE", 14, 17), ("NAME", 7, 10)])], f"t string, s {spans}")
    assert row.select(T.redact_spans(F.col("t"), F.col("s")).alias("r")).first().r == "call 🙂 [NAME] at [PHONE]"
    assert row.select(T.redact_spans(F.col("t"), F.array().cast(spans)).alias("r")).first().r == "call 🙂 Ann at 555"


def test_ratings_and_dates(spark):
    assert many(spark, ["4", " 5 ", "4.7", "0", "6", "", "x", None, "99999999999"], V.rating) == [4, 5, None, None, None, None, None, None, None]
    assert many(spark, ["2026-01-05", "2026-1-5", "2026-02-30", "05/01/2026", "", None], V.iso_date) == ["2026-01-05", "2026-01-05", None, None, None, None]
    assert many(spark, ["Very Satisfied", "Neutral", "neutral", "", None], V.satisfaction_ordinal) == [5, 3, None, None, None]


def test_gap(spark):
    rows = spark.createDataFrame([(5, 1, 1), (2, 5, 5), (3, None, 4), (3, None, None), (None, 1, 2), (4, 3, 4)], "o int, p int, s int")
    assert [r.g for r in rows.select(V.satisfaction_gap(F.col("o"), F.col("p"), F.col("s")).alias("g")).collect()] == [4.0, -3.0, -1.0, None, None, 0.5]


def test_json_recovery(spark):
    text = many(spark, ['{"a":1}', 'Sure: {"a":2} done', "plain prose", '{"a":', "} {"], lambda c: F.to_json(V.recovered_json(c)))
    assert text == ['{"a":1}', '{"a":2}', None, None, None]


def packed(texts, limit):
    out = []
    for t in texts:
        if len(t.encode()) > limit:
            out.append((t.encode()[:limit].decode("utf-8", "ignore"), 1, True))
        elif out and not out[-1][2] and len((out[-1][0] + " " + t).encode()) <= limit:
            out[-1] = (out[-1][0] + " " + t, out[-1][1] + 1, False)
        else:
            out.append((t, 1, False))
    return out


def test_packing_of_turns(spark):
    rng = random.Random(5)
    lists = [["short", "x" * 150, "after"], []] + [["".join(rng.choice("ab é日") for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 9))] for _ in range(40)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, t array<string>").select("i", calls.pack_turns(F.col("t"), 100).alias("p")).collect()
    for r in rows:
        assert [tuple(c) for c in r.p] == packed(lists[r.i], 100)


def test_packing_a_call_of_very_many_turns(spark):
    """In pieces of one turn, of many, and of both: chunks are found block by block, and none is copied for each turn."""
    for own in ([f"turn {i} " + "x" * (i % 90) for i in range(100_000)], ["y" * 300] * 20_000, [("y" * 300, "z")[i // 700 % 2] for i in range(20_000)]):
        got = spark.createDataFrame([(own,)], "t array<string>").select(calls.pack_turns(F.col("t"), 500).alias("p")).first().p
        sizes, room, last = [], -1, None
        for text in own:
            if sizes and len(text) + 1 <= room:
                sizes[-1] += 1
                room -= len(text) + 1
            else:
                sizes.append(1)
                room = 500 - len(text)
            last = text
        assert [c.n_turns for c in got] == sizes and got[-1].text.endswith(last)
        assert " ".join(c.text for c in got) == " ".join(own)
