"""Call transcripts: turns, roles, packed documents for sentiment, results by index, summaries.

Segments are rows (call_id, pos, speaker, text, start_time, end_time). Everything is keyed by call_id, so one exchange
on it serves the windows and aggregates that follow; order is always an explicit position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.text import MAX_BYTES, strip, truncate_bytes

# Fixed values.
SLOTS = {"customer_all": "customer_overall", "agent_all": "agent_overall", "customer_end": "customer_end_state"}
SCORE_KEYS = ("Positive", "Negative", "Neutral", "Mixed")
BATCH = 25


def segments(transcripts: DataFrame, array: str = "results.audio_segments") -> DataFrame:
    """Segment rows of transcripts (call_id and an array of speaker-labelled segments)."""
    exploded = transcripts.select("call_id", F.posexplode(array).alias("pos", "s"))
    return exploded.select("call_id", "pos", F.coalesce("s.speaker_label", F.lit("unknown")).alias("speaker"), F.col("s.transcript").alias("text"), F.col("s.start_time").alias("start_time"), F.col("s.end_time").alias("end_time"))


def merge_turns(rows: DataFrame) -> DataFrame:
    """call_id, turn (from 0), speaker, start_time, end_time, text: segments of one speaker in a row become a turn; blank
    ones go first, so they part nothing."""
    along = Window.partitionBy("call_id").orderBy("pos")
    kept = rows.withColumn("text", strip("text")).where("text <> ''")
    change = F.when(F.col("speaker").eqNullSafe(F.lag("speaker").over(along)) & (F.row_number().over(along) > 1), 0).otherwise(1)
    island = kept.withColumn("change", change).withColumn("turn", (F.sum("change").over(along.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "text")))
    merged = island.groupBy("call_id", "turn").agg(
        F.first("speaker").alias("speaker"),
        F.min_by(F.col("start_time").try_cast("double"), "pos").alias("start_time"),
        F.max_by(F.col("end_time").try_cast("double"), "pos").alias("end_time"),
        F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"),
    )
    return merged


def infer_roles(turns: DataFrame) -> DataFrame:
    """call_id, speaker, role_guess, role_method: of exactly two speakers the first to speak is taken for the agent;
    otherwise nobody's role is known."""
    first = turns.groupBy("call_id", "speaker").agg(F.min("turn").alias("first"))
    every = Window.partitionBy("call_id")
    two = F.count("*").over(every) == 2
    rank = F.row_number().over(every.orderBy("first"))
    return first.select(
        "call_id",
        "speaker",
        F.when(two, F.when(rank == 1, "agent").otherwise("customer")).otherwise("unknown").alias("role_guess"),
        F.when(two, "first_speaker").otherwise(F.concat(F.lit("not_inferred:speaker_count="), F.count("*").over(every))).alias("role_method"),
    )


def named_turns(turns: DataFrame) -> DataFrame:
    """Turns with role_guess, as `infer_roles` tells it, by windows over the turns themselves: they are made once."""
    call = Window.partitionBy("call_id")
    first = F.col("turn") == F.min("turn").over(Window.partitionBy("call_id", "speaker"))
    opener = F.min_by("speaker", "turn").over(call)
    role = F.when(F.count_if("_first").over(call) != 2, "unknown").when(F.col("speaker").eqNullSafe(opener), "agent").otherwise("customer")
    return turns.withColumn("_first", first).withColumn("role_guess", role).drop("_first")


def with_roles(turns: DataFrame, roles: DataFrame) -> DataFrame:
    """Turns with role_guess; speakers without a role are unknown."""
    return turns.join(roles, ["call_id", "speaker"], "left").withColumn("role_guess", F.coalesce("role_guess", F.lit("unknown")))


def render_dialogue(turns: DataFrame) -> DataFrame:
    """call_id, text: lines of "role: what was said" of turns with roles."""
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.col("role_guess"), F.lit(": "), strip("text")).alias("line"))))
    return turns.groupBy("call_id").agg(F.array_join(F.transform(lines, lambda p: p["line"]), "\n").alias("text"))


def last_customer_turn(turns: DataFrame) -> DataFrame:
    """call_id, turn, text of each call's last customer turn."""
    own = turns.where("role_guess = 'customer'").groupBy("call_id").agg(F.max(F.struct("turn", "text")).alias("t"))
    return own.select("call_id", "t.*")


CHUNKS = "array<struct<text:string,n_turns:int,truncated:boolean>>"


FOLD = 512  # texts whose chunks one fold lists: a fold copies its list for each element


def _chunk_starts(sizes: Column, limit: int) -> Column:
    """The places of the texts, told by their bytes, that begin a chunk. A first fold over blocks of FOLD texts carries the
    last chunk's bytes from block to block; then each block lists its own. A text that is too long by itself leaves no room
    after it."""

    def joined(held: Column, size: Column) -> Column:
        return F.when(held + 1 + size <= limit, held + 1 + size).otherwise(size)

    def carry(held: Column, block: Column) -> Column:
        after = F.aggregate(block, held["bytes"], joined)
        return F.struct(after.alias("bytes"), F.concat(held["carried"], F.array(held["bytes"])).alias("carried"))

    def add(held: Column, size: Column) -> Column:
        starts = F.when(held["bytes"] + 1 + size <= limit, held["starts"]).otherwise(F.concat(held["starts"], F.array(held["at"])))
        return F.struct((held["at"] + 1).alias("at"), joined(held["bytes"], size).alias("bytes"), starts.alias("starts"))

    def listed(blocks: Column) -> Column:
        nothing = F.struct(F.lit(limit).cast("long").alias("bytes"), F.array().cast("array<bigint>").alias("carried"))

        def starts(carried: Column) -> Column:
            def own(block: Column, k: Column) -> Column:
                zero = F.struct((k * FOLD).alias("at"), F.get(carried, k).alias("bytes"), F.array().cast("array<int>").alias("starts"))
                return F.aggregate(block, zero, add)["starts"]

            return F.flatten(F.transform(blocks, own))

        return let(F.aggregate(blocks, nothing, carry)["carried"], starts)

    def blocks(own: Column) -> Column:
        each = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(own) / FOLD).cast("int") - 1, F.lit(0)))
        return F.transform(each, lambda k: F.slice(own, k * FOLD + 1, F.lit(FOLD)))

    return let(let(F.transform(sizes, lambda b: b.cast("long")), blocks), listed)


def pack_turns(texts: Column, limit: int = MAX_BYTES) -> Column:
    """An array of texts packed greedily, in order, into chunks of at most `limit` bytes, joined by a blank. A text that is
    too long by itself is cut, flagged, and nothing is added to it. Each text is looked at once and joined once; only the
    places of the chunks are carried along."""

    def packed(own: Column) -> Column:
        sizes = F.transform(own, F.octet_length)

        def chunks(starts: Column) -> Column:
            def chunk(begin: Column, i: Column) -> Column:
                n = F.coalesce(F.get(starts, i + 1), F.size(own)) - begin
                text = F.array_join(F.slice(own, begin + 1, n), " ")
                cut = (n == 1) & (F.octet_length(text) > limit)
                return F.struct(F.when(cut, truncate_bytes(text, limit)).otherwise(text).alias("text"), n.alias("n_turns"), cut.alias("truncated"))

            return F.transform(starts, chunk)

        return let(_chunk_starts(sizes, limit), chunks)

    return F.coalesce(let(texts, packed).cast(CHUNKS), F.when(texts.isNotNull(), F.array().cast(CHUNKS)))


def slot_documents(turns: DataFrame, limit: int = MAX_BYTES) -> DataFrame:
    """call_id, item (from 0 within the call), slot, part, text, n_turns, truncated of turns with roles: what the customer
    said, what the agent said, and how the customer ended. Calls whose roles are unknown send nothing."""
    said = turns.where("role_guess in ('customer', 'agent')").groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role_guess", "text"))).alias("said"))
    of = lambda role: F.transform(F.filter("said", lambda t: t["role_guess"] == role), lambda t: t["text"])
    customer = of("customer")
    texts = {"customer_all": customer, "agent_all": of("agent"), "customer_end": F.slice(customer, F.greatest(F.size(customer), F.lit(1)), F.lit(1))}
    def parts(slot: str, own: Column) -> Column:
        return F.transform(pack_turns(own, limit), lambda c, i: F.struct(F.lit(slot).alias("slot"), i.alias("part"), c["text"].alias("text"), c["n_turns"].alias("n_turns"), c["truncated"].alias("truncated")))

    tagged = [parts(slot, own) for slot, own in texts.items()]
    return said.select("call_id", F.posexplode(F.concat(*tagged)).alias("item", "d")).select("call_id", "item", "d.*")


def batched(items: DataFrame, size: int = BATCH) -> DataFrame:
    """Items with batch and index: the service takes `size` documents a call."""
    return items.withColumns({"batch": F.floor(F.col("item") / size).cast("int"), "index": (F.col("item") % size).cast("int")})


def apply_results(items: DataFrame, results: DataFrame, errors: DataFrame) -> DataFrame:
    """Batched items with sentiment, sentiment_scores and sentiment_error, by call, batch and index and never by the order
    of results, in which failures leave gaps. `results` has call_id, batch, index, sentiment, sentiment_scores; `errors`
    has call_id, batch, index, error."""
    on = ["call_id", "batch", "index"]
    joined = items.join(results, on, "left").join(errors.withColumnRenamed("error", "sentiment_error"), on, "left")
    failed = F.col("sentiment_error").isNotNull()
    return joined.withColumn("sentiment", F.when(~failed, F.col("sentiment")))


def slot_summary(scored: DataFrame, calls: DataFrame) -> DataFrame:
    """A row for each call of `calls` and slot: the byte-weighted mean of its parts' scores, the label of the highest, how
    many parts and turns went in, or the reason why there is none. Of equal scores, the first key wins."""
    slots = F.create_map(*(F.lit(x) for pair in SLOTS.items() for x in pair))
    has = F.col("sentiment_scores").isNotNull()
    weight = F.octet_length("text")
    means = [F.try_divide(F.sum(F.when(has, F.element_at("sentiment_scores", k) * weight)), F.sum(F.when(has, weight))).alias(k) for k in SCORE_KEYS]
    own = scored.groupBy("call_id", "slot").agg(*means, F.count("*").cast("int").alias("parts"), F.count_if(has).cast("int").alias("parts_scored"), F.sum(F.when(has, F.col("n_turns"))).cast("int").alias("turns_used"), F.bool_or("truncated").alias("truncated"))
    every = calls.select("call_id").distinct().withColumn("slot", F.explode(F.array(*map(F.lit, SLOTS))))
    ranked = F.array_max(F.array(*(F.struct(F.col(k).alias("score"), F.lit(-i).alias("order"), F.lit(k.upper()).alias("label")) for i, k in enumerate(SCORE_KEYS))))
    done = F.col("parts_scored") > 0
    return every.join(own, ["call_id", "slot"], "left").select(
        "call_id",
        slots[F.col("slot")].alias("slot"),
        F.when(done, ranked["label"]).alias("sentiment"),
        F.when(done, F.create_map(*(x for k in SCORE_KEYS for x in (F.lit(k), F.col(k))))).alias("scores"),
        F.when(done, F.lit("comprehend_speaker_concat")).alias("method"),
        F.when(done, F.col("parts")).alias("parts"),
        F.when(done, F.col("parts_scored")).alias("parts_scored"),
        F.when(done, F.col("turns_used")).alias("turns_used"),
        F.when(done, F.col("truncated")).alias("truncated"),
        F.when(F.col("parts").isNull(), "no_text_for_role").when(~done, "comprehend_error").alias("reason"),
    )


def call_records(jobs: DataFrame, transcripts: DataFrame, turns: DataFrame, roles: DataFrame, scored: DataFrame, summary: DataFrame) -> DataFrame:
    """One record for each completed job: jobs has call_id, job_name, status, source_audio, transcript_key; transcripts has
    call_id, full_transcript. The documents are listed without their texts."""
    ordered = lambda fields, key: F.transform(F.array_sort(F.collect_list(F.struct(key, F.struct(*fields).alias("own")))), lambda x: x["own"])
    said = turns.groupBy("call_id").agg(ordered(("speaker", "start_time", "end_time", "text"), "turn").alias("turns"))
    who = roles.groupBy("call_id").agg(F.map_from_entries(F.collect_list(F.struct("speaker", F.struct("role_guess", "role_method").alias("role")))).alias("speakers"))
    docs = scored.groupBy("call_id").agg(
        ordered(("slot", "part", "n_turns", "truncated", "sentiment"), "item").alias("sentiment_docs"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("sentiment_error").isNotNull(), F.struct(F.col("item").alias("index"), F.col("sentiment_error").alias("error"))))), lambda x: x).alias("sentiment_errors"),
    )
    feeling = summary.groupBy("call_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("sentiment", "scores", "method", "parts", "parts_scored", "turns_used", "truncated", "reason").alias("own")))).alias("sentiment"))
    out = jobs.where("status = 'COMPLETED'").join(transcripts, "call_id")
    for part in (who, said, feeling, docs):
        out = out.join(part, "call_id", "left")
    return out


def failure_records(jobs: DataFrame, now: Column) -> DataFrame:
    """A record for each failed job; what is missing says so."""
    return jobs.where("status = 'FAILED'").select("job_name", "status", F.coalesce("source_audio", F.lit("unknown")).alias("source_audio"), F.coalesce("failure_reason", F.lit("not provided")).alias("failure_reason"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss").alias("recorded_at"))


def request_designs(turns: DataFrame) -> DataFrame:
    """call_id, design, texts: one document a turn (a), or one a speaker and one for the customer's end (b)."""
    every = F.array_sort(F.collect_list(F.struct("turn", "role_guess", "text")))
    own = turns.groupBy("call_id").agg(every.alias("said"))
    text = lambda xs: F.transform(xs, lambda t: t["text"])
    by = lambda role: text(F.filter("said", lambda t: t["role_guess"] == role))
    customer = by("customer")
    joined = F.filter(F.array(F.array_join(customer, " "), F.array_join(by("agent"), " "), F.try_element_at(customer, F.lit(-1))), lambda t: t != "")
    return own.select("call_id", F.inline(F.array(F.struct(F.lit("a").alias("design"), text(F.col("said")).alias("texts")), F.struct(F.lit("b").alias("design"), joined.alias("texts")))))


def billed_units(designs: DataFrame) -> DataFrame:
    """call_id, design, units: characters billed, 300 for each document at least."""
    return designs.select("call_id", "design", F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.greatest(F.lit(300), F.length(t))).alias("units"))


def transcription_requests(events: DataFrame, bucket: Column, key: Column, now: Column) -> DataFrame:
    """Requests of audio of a known format: other keys are left out."""
    from ..functions.text import job_name, media_format, staged_key

    return events.withColumn("media_format", media_format(key)).where("media_format is not null").select(
        job_name(key, now).alias("job_name"), F.concat(F.lit("s3://"), bucket, F.lit("/"), key).alias("media_uri"), "media_format",
        F.lit("en-US").alias("language_code"), bucket.alias("output_bucket"), staged_key(key, "transcriptions", ".json").alias("output_key"),
        F.struct(F.lit(True).alias("ShowSpeakerLabels"), F.lit(2).alias("MaxSpeakerLabels")).alias("settings"),
    )
