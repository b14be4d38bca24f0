"""String, key and address functions as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let

# Patterns and limits that results depend on. Fixed values.
ORDER_PATTERNS = (r"(?i)\bORD[- ]?(\d{3,})\b", r"(?i)\border\s*(?:#|no\.?|number)?\s*(\d{3,})\b")
SAFE_IDENTIFIERS = (r"^[A-Z]{2,4}-\d{3,5}$", r"(?i)^CUST-\d+$", r"(?i)^ORD-\d+$")
IMAGE_NAME = r"^([A-Z]+-\d+)_(CUST-\d+)$"
AUDIO_FORMATS = ("mp3", "mp4", "wav", "flac", "ogg", "amr", "webm", "m4a")
IMAGE_FORMATS = ("png", "jpg", "jpeg")
MAX_BYTES = 5000
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
JOB_NAME_MAX, JOB_PREFIX = 200, "feedback-"


def strip(c: Column | str) -> Column:
    """Without white space at either end, of any kind; cut off from the ends, however long it is."""
    return F.btrim(c, F.lit(WHITE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null without one."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def truncate_bytes(text: Column, limit: int = MAX_BYTES) -> Column:
    """At most `limit` bytes of UTF-8, cut between characters: of the four cuts that can end one, the longest valid."""
    raw = text.cast("binary")
    cuts = [F.try_validate_utf8(F.substring(raw, 1, limit - i).cast("string")) for i in range(min(4, limit + 1))]
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.coalesce(*cuts))


def base_name(key: Column) -> Column:
    return F.regexp_extract(key, r"[^/]*$", 0)


def stem(key: Column) -> Column:
    """The file name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(base_name(key), r"(?<=[^.])\.[^.]*$", "")


def document_stem(key: Column) -> Column:
    return F.replace(stem(key), F.lit("_processed"), F.lit(""))


def extension(key: Column) -> Column:
    """Lower-case, without its dot; empty without one."""
    return F.lower(F.regexp_extract(base_name(key), r"[^.]\.([^.]*)$", 1))


def media_format(key: Column, known: Iterable[str] = AUDIO_FORMATS) -> Column:
    """The extension if it is a known one, else null."""
    own = extension(key)
    return F.when(own.isin(*known), own)


def order_ref(text: Column) -> Column:
    """ORD-<digits> of the first pattern that matches, or null."""
    return F.concat(F.lit("ORD-"), F.coalesce(*(first_group(F.coalesce(text, F.lit("")), p) for p in ORDER_PATTERNS)))


def is_safe_identifier(span: Column) -> Column:
    own, out = strip(span), F.lit(False)
    for pattern in SAFE_IDENTIFIERS:
        out = out | own.rlike(pattern)
    return out


def image_ids(key: Column) -> Column:
    """struct(product_id, customer_id) told by a file name; both empty if it has another form."""
    own = stem(key)
    return F.struct(F.regexp_extract(own, IMAGE_NAME, 1).alias("product_id"), F.regexp_extract(own, IMAGE_NAME, 2).alias("customer_id"))


def job_name(key: Column, now: Column) -> Column:
    """At most 200 of the allowed characters: prefix, the file's stem, and the time."""
    safe = F.regexp_replace(stem(key), r"[^0-9a-zA-Z._-]", "-")
    budget = JOB_NAME_MAX - len(JOB_PREFIX) - len("-20260101T000000")
    return F.concat(F.lit(JOB_PREFIX), F.left(safe, F.lit(budget)), F.lit("-"), F.date_format(now, "yyyyMMdd'T'HHmmss"))


def decode_event_key(key: Column) -> Column:
    """A key as notifications write it: + is a blank, %XX a byte."""
    return F.url_decode(key)


def _unquote(c: Column) -> Column:
    """%XX decoded, + left as it is."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def object_address(uri: Column) -> Column:
    """struct(bucket, key) of s3://bucket/key, a path-style or a virtual-hosted address."""
    rest = F.regexp_replace(uri, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = _unquote(F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), r"^/+", ""))
    plain, by_path = uri.rlike("^s3://"), host.rlike(r"^s3[.-]")
    bucket = F.when(plain, host).when(by_path, F.regexp_extract(path, r"^[^/]*", 0)).otherwise(F.split_part(host, F.lit(".s3."), F.lit(1)))
    key = F.when(~plain & by_path, F.regexp_extract(path, r"^[^/]*/(.*)$", 1)).otherwise(path)
    return F.struct(bucket.alias("bucket"), key.alias("key"))


def validation_to_raw_key(key: Column) -> Column:
    """The raw review that a validation result is about."""
    return F.replace(F.replace(key, F.lit("validation-results/reviews"), F.lit("raw-data/reviews")), F.lit("_validation.json"), F.lit(".json"))


def raw_to_validation_key(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("raw-data/reviews"), F.lit("validation-results/reviews")), F.lit(".json"), F.lit("_validation.json"))


def validation_to_processed_key(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("validation-results/reviews"), F.lit("processed-data/reviews")), F.lit("_validation.json"), F.lit("_processed.json"))


def image_to_processed_key(key: Column) -> Column:
    moved = F.replace(key, F.lit("raw-data/images"), F.lit("processed-data/images"))
    return F.concat(F.regexp_replace(moved, r"(?<=[^./])\.[^./]*$", ""), F.lit("_processed.json"))


def staged_key(key: Column, prefix: str, suffix: str) -> Column:
    """The key of what a stage makes of `key`: prefix, stem and suffix."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), stem(key), F.lit(suffix))


BLOCK = 1024  # characters


def _pieces(text: Column, begins: Column, ends: Column) -> Column:
    """array of text[begin:end], in characters, for arrays of begins and ends. The text is cut into blocks once; a piece
    costs its own length and a block at most, however far back it stands."""

    def cut(blocks: Column) -> Column:
        def piece(begin: Column, end: Column) -> Column:
            first, last = F.floor(begin / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
            own = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
            return F.when(end > begin, F.substring(own, begin % BLOCK + 1, end - begin)).otherwise("")

        return F.zip_with(begins, ends, piece)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), cut)


def _rewritten_one_by_one(text: Column, spans: Column) -> Column:
    step = lambda out, s: F.concat(F.left(out, s["BeginOffset"]), F.lit("["), s["Type"], F.lit("]"), F.substring(out, s["EndOffset"] + 1, F.length(out)))
    return F.aggregate(F.reverse(spans), text, step)


def redact_spans(text: Column, spans: Column) -> Column:
    """Each span (Type, BeginOffset, EndOffset in characters) replaced by its [Type]. What lies between the spans and what
    takes their places is joined once. Spans that overlap, which no pattern gives, are replaced from the last to the first,
    each in what the one before left; of spans that begin at one place, the last of the array first."""
    numbered = F.transform(spans, lambda s, i: F.struct(s["BeginOffset"].alias("BeginOffset"), (-i).alias("i"), s["EndOffset"].alias("EndOffset"), s["Type"].alias("Type")))

    def rewrite(held: Column) -> Column:
        own, length = held["own"], held["length"]
        ends = F.transform(own, lambda s: s["EndOffset"])
        begins = F.transform(own, lambda s: s["BeginOffset"])
        between = _pieces(text, F.concat(F.array(F.lit(0)), ends), F.concat(begins, F.array(length)))
        marks = F.concat(F.transform(own, lambda s: F.concat(F.lit("["), s["Type"], F.lit("]"))), F.array(F.lit("")))
        joined = F.array_join(F.zip_with(between, marks, lambda a, b: F.concat(a, b)), "")
        apart = F.forall(F.transform(own, lambda s, i: F.when(i > 0, F.get(own, i - 1)["EndOffset"] <= s["BeginOffset"]).otherwise(True)), lambda x: x)
        inside = F.forall(own, lambda s: (s["BeginOffset"] >= 0) & (s["BeginOffset"] <= s["EndOffset"]) & (s["EndOffset"] <= length))
        return F.when(F.size(own) == 0, text).when(apart & inside, joined).otherwise(_rewritten_one_by_one(text, own))

    return let(F.struct(F.array_sort(numbered).alias("own"), F.length(text).alias("length")), rewrite)


def top_score(scores: Column, label: Column) -> Column:
    """A provider's confidence in the label that it chose; its keys are capitalised."""
    return F.bround(F.try_element_at(scores, F.initcap(label)), 4)
