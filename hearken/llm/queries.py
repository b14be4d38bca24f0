"""The queries opN_<name> over the documents table, and the SQL that tells the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, jaccard_join, language, licenses, media, packing, phrases, quality, simhash, substring_dedup, token_files, whitening
from .common import read_documents


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(n: int):
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cleaned(read_documents(spark, sf_dir), texts=False)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.to_media(read_documents(spark, sf_dir)))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(read_documents(spark, sf_dir), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.grouped(read_documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = language.fit(docs, remainder(3) != 1)
    return language.predict(docs, model).select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_documents(spark, sf_dir), keep="largest")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.classify(read_documents(spark, sf_dir), labels, remainder(4) != 2)
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read_documents(spark, sf_dir), _vocabulary("word_bpe_49k.json")))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.index_tokens(token_files.write_tokens(read_documents(spark, sf_dir), _vocabulary("word_bpe_49k.json")))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(read_documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read_documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation is null where it passes 64 bits; the operator itself has it whole."""
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_media_columns, op3_byte_bpe, op4_jaccard_join, op5_language_id, op6_license_scan,
        op7_exact_dedup, op8_quality, op9_packing, op10_token_files, op11_simhash, op12_collocations, op13_whitening,
    )
}

ORACLE_SQL = {
    "op6_license_scan": licenses.oracle(),
    "op1_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
                         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
             firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
             cut AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p
                     FROM windows JOIN firsts USING (k) WHERE doc_id > f)),
             gone AS (SELECT doc_id, list(p) AS ps FROM cut GROUP BY doc_id),
             words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
             kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(g.ps), 0)::BIGINT AS n_removed,
               sha256(coalesce(k.t, '')) AS kept_sha256
        FROM d LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
    # Shingles that two documents share are counted by a join on them, and links are followed from each document.
    "op4_jaccard_join": r"""
        WITH RECURSIVE
             d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 4], ' ')) AS k
                   FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM d)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
             links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
             ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
             reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, ways.y FROM reach JOIN ways ON reach.b = ways.x)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)""",
    # Every phrase is counted; a longer phrase occurs no more often than what it contains, so "as often" is equal counts.
    "op12_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
             pieces AS (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) AS p FROM d),
             w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
             g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
                   FROM w, (SELECT unnest(range(1, 6)) AS k)),
             f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
             totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
             c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND n >= 100),
             swallowed AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN c q ON q.lang = c.lang AND q.a = c.a AND q.k > c.k
                           WHERE contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' ')),
             cuts AS (SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp
                      FROM (SELECT c.*, unnest(range(1, k)) AS j FROM c ANTI JOIN swallowed USING (lang, phrase))),
             scored AS (SELECT lang, cuts.phrase, a, j, x.n AS l, y.n AS r, totals.n AS n, ((1000::HUGEINT * a * totals.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
                        FROM cuts JOIN f x USING (lang) JOIN f y USING (lang) JOIN totals USING (lang) WHERE x.phrase = lp AND y.phrase = rp),
             best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
}
