"""Every query of the catalogue beside its SQL, on the smallest tables."""

import os
import re

import duckdb
import pytest

from hearken.operators import providers
from hearken.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "orders", "customer", "events", "pages", "conversations", "part", "benchmark")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in catalogue.ORACLE_SQL:
        out = duck.sql(catalogue.ORACLE_SQL[name])
        names = sorted(out.columns)
        assert names == sorted(df.columns)
        at = [out.columns.index(c) for c in names]
        assert sorted(repr(tuple(r[c] for c in names)) for r in rows) == sorted(repr(tuple(r[i] for i in at)) for r in out.fetchall())


def test_themes_come_from_all_documents(spark, tmp_path):
    spark.createDataFrame([(1000, "a", "en"), (70001, "b", None)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = catalogue.theme_keyword_recall(spark, str(tmp_path)).collect()
    assert sorted((r.product_id, r.found) for r in rows) == [("P0", True), ("P1", True), ("P2", False)]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_whole_texts_are_redacted(spark, tmp_path):
    odd = "\x02EMAIL\x03 x@y.example\x04 " + "a" * 500 + "555-123-4567@mail.example then 555-123-4567"
    texts = ["filler words " * 3000 + "write to ann@mail.example, 123-45-6789, 4111 1111 1111 1111 or ABC-123, order #4567", odd, None, "", "é 日本 (555) 123-4567 a@b.example a@b.example ORD-778"]
    texts += ["Mrs Ann Lee, 12 Upper Baker Street: 1234 5678 9012 3456 is no card, 4111-1111-1111-1111 is", "0000 0000 0000 0000 7 Oak Rd"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    tally = {}
    got = {r.doc_id: r for r in catalogue.pii_redact_documents(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        text, spans = (text or "").strip(), []
        for name, pattern in providers.PII:
            for m in re.finditer(pattern, text, re.ASCII):
                if name in providers.CHECKED and not luhn(m[0]):
                    continue
                if not any(m.start() < e and b < m.end() for b, e, _ in spans):
                    spans.append((m.start(), m.end(), name))
        safe = [s for s in spans if re.fullmatch(r"[A-Z]{2,4}-\d{3,5}|(?i:CUST|ORD)-\d+", text[s[0] : s[1]])]
        types = sorted({s[2] for s in spans if s not in safe})
        kept = [text[b:e] for b, e, _ in safe]
        for key in [("redacted", t) for t in types] + [("allowlisted", k) for k in kept]:
            tally[key] = tally.get(key, 0) + 1
        for b, e, name in sorted(set(spans) - set(safe), reverse=True):
            text = text[:b] + f"[{name}]" + text[e:]
        assert (got[str(i)].text, got[str(i)].types, got[str(i)].kept or "") == (text, ",".join(types), ",".join(sorted(set(kept))))
    assert {(r.kind, r.name): r.n for r in catalogue.pii_tally_documents(spark, str(tmp_path)).collect()} == tally
    assert {"EMAIL", "SSN", "PHONE", "CREDIT_DEBIT_NUMBER"} <= {name for _, name in tally}
    refs = {r.doc_id: r.order_ref for r in catalogue.order_ref_documents(spark, str(tmp_path)).collect()}
    assert refs == {0: "ORD-4567", 1: None, 2: None, 3: None, 4: "ORD-778", 5: None, 6: None}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
