"""Secret scans, personal data and quality rules against plain definitions."""

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import EDGES, FOLDER
from tidegauge.llm import pii, quality_rules, queries, secret_scan


def _secret_rows(frame):
    strict = secret_scan.strict_spans(F.col("spans"))
    return frame.select("doc_id", secret_scan.listed(strict).alias("base"), secret_scan.listed(F.col("spans")).alias("all"))


def _by_start(text):
    return brute.listed(sorted(brute.found(brute.SECRETS, text), key=lambda s: (s[2], s[0])))


def _by_kind(text):
    return brute.listed(sorted(brute.found(brute.PERSONAL, text), key=lambda s: (s[0], s[2])))


def test_secrets_of_the_corpus(spark, texts):
    for r in queries.op5_secret_scan(spark, FOLDER).collect():
        spans = brute.found(brute.SECRETS, texts[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(_by_start(texts[r["doc_id"]]))
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(s[1] == kind for s in spans)
        assert set(filter(None, _by_start(texts[r["doc_id"]]).split(","))) <= set(r["spans"].split(","))


def test_secrets_of_odd_rows(edge_docs):
    rows = sorted((r["doc_id"] or -1, r["base"]) for r in _secret_rows(secret_scan.scan(edge_docs)).collect())
    assert rows == sorted((i or -1, _by_start(t)) for i, t in EDGES)


MAILS = " ".join(f"m{i}@b{i}.org" for i in range(4000))
LONG = {
    "one address": "a@b" + ".c" * 200_000, "mails": MAILS, "starts of tokens": "eyJ" * 100_000, "unmarked": "aB3" * 200_000 + " x" + "aB" * 100_000,
    "mails and numbers": " ".join(f"m{i}@b{i}.org, 12 345 {i:04d} 77" for i in range(4000)),
    "plain": "word mail a.b " * 750_000,
}


@pytest.mark.parametrize("name", LONG)
def test_long_texts_neither_end_nor_stall_a_job(spark, name):
    text = LONG[name]
    docs = spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")
    private = pii.find_personal(docs).select(pii.listed(F.filter("spans", lambda s: s["strict"]))).first()[0]
    secrets = _secret_rows(secret_scan.scan(docs)).first()["base"]
    if name in ("starts of tokens", "unmarked"):  # the plain definitions take a step for each pair of characters here
        assert private == secrets == ""
    else:
        assert private == _by_kind(text) and secrets == _by_start(text)


def test_a_token_starts_at_the_beginning_of_a_run(spark):
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    docs = spark.createDataFrame([(1, f"a {token} b", "s"), (2, "x" + token, "s")], "doc_id bigint, text string, source string")
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    assert found[1] == [("jwt", 2, 2 + len(token))] and found[2] == []


def test_context_comes_from_between_the_hits(spark):
    from tidegauge.llm.common import in_context, overlaps_any, span_blocks

    text = "é call 11 22,x33"
    shown = spark.createDataFrame([(text,), ("",), (None,), ("7",)], "t string").select(in_context(F.col("t"), "[0-9]+", 6).alias("c"))
    got = [r["c"] and [tuple(m) for m in r["c"]] for r in shown.collect()]
    assert got == [
        [(7, 9, "11", " call ", " "), (10, 12, "22", "11 ", ","), (14, 16, "33", "22,x", "")], [], None, [(0, 1, "7", "", "")]]
    spans = [(i * 10, i * 10 + 3 + (1000 if i == 5 else 0)) for i in range(600)]
    asked = [(4, 8), (12, 13), (2000, 2001), (1055, 1058), (1054, 1059), (6005, 6009), (0, 9999)]
    frame = spark.createDataFrame([(spans, asked)], "s array<struct<start:int,end:int>>, q array<struct<start:int,end:int>>")
    hits = frame.withColumn("b", span_blocks(F.col("s"))).select(F.transform("q", lambda q: overlaps_any(F.col("b"), q))).first()[0]
    assert hits == [any(a < e and s < b for a, b in spans) for s, e in asked]


def test_ownership_decides_loose_candidates(spark):
    token = "ghp_" + "aB3dE5gH7jK9mN1pQ3rS"
    copied = "ghp_" + "zY8xW6vU4tS2rQ0pO8nM"
    rows = [(1, f"x {token}", "a")] + [(10 + i, f"y {copied} z", f"o{i}") for i in range(4)] + [(30, "ghp_" + "a" * 20, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).collect()}
    assert [(s["kind"], s["start"], s["verdict"]) for s in found[1]] == [("prefixed", 2, "live")]
    assert all(found[i] == [] for i in (10, 11, 12, 13, 30))


def test_ownership_decides_unmarked_strings(spark):
    own, copied, word = "q7RtY2mK9sLx4Wv8ZbNd3H", "aB3dE5gH7jK9mN1pQ3rS5t", "InternationalisationReport2024"
    rows = [(1, f"key {own}, {word}", "a"), (2, f"token = {own}", "a"), (3, own.lower() + " " + "A1" * 12, "a")]
    rows += [(10 + i, f"e.g. {copied}", f"o{i}") for i in range(3)] + [(20, "x" * 10 + own, "a"), (21, f"_{own}-", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["verdict"]) for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    assert found[1] == [("entropy", 4, 4 + len(own), "live")] and found[2] == [("assign", 0, 8 + len(own), "live")]
    assert found[3] == [] and all(found[10 + i] == [] for i in range(3))
    assert found[20] == [("entropy", 0, 10 + len(own), "live")] and found[21] == [("entropy", 1, 1 + len(own), "live")]


def test_very_many_repositories_of_one_owner_are_copies(spark):
    own, copied = "ghp_" + "aB3dE5gH7jK9mN1pQ3rS", "ghp_" + "zY8xW6vU4tS2rQ0pO8nM"
    rows = [(i, f"x {copied}", "hot") for i in range(150)] + [(1000 + i, f"x {own}", "hot") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: [s["verdict"] for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    assert all(found[i] == [] for i in range(150)) and all(found[1000 + i] == ["live"] for i in range(5))


def test_personal_data_of_the_corpus(spark, texts):
    for r in queries.op8_pii(spark, FOLDER).collect():
        spans = brute.found(brute.PERSONAL, texts[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(_by_kind(texts[r["doc_id"]])), r
        for kind in pii.STRICT:
            assert r[f"n_{kind}"] == sum(s[1] == kind for s in spans)


def test_personal_data_of_odd_rows(edge_docs):
    rows = pii.find_personal(edge_docs).select(
        "doc_id", pii.listed(F.filter("spans", lambda s: s["strict"])).alias("base")).collect()
    assert sorted((r["doc_id"] or -1, r["base"]) for r in rows) == sorted((i or -1, _by_kind(t)) for i, t in EDGES)


def test_boosting_learns_a_feature_and_calibrates():
    cell = dict.fromkeys(pii.FEATURES, 0)
    cells = [
        cell | {"cue": cue, "confirmed": bool(yes), "held": held, "n": n}
        for held in (False, True) for cue, yes, n in ((1, 1, 400), (1, 0, 4), (0, 1, 10), (0, 0, 400))]
    model = pii.fit(cells)
    assert model.trees and model.threshold < float("inf")
    assert pii.fit([c for c in cells if c["confirmed"]]).threshold == float("inf")
    assert pii.fit([]).threshold == float("inf")


def test_many_emails_do_not_vouch_for_numbers(spark):
    rows = [(i, f"mail a{i}@b.io, c{i}@d.io, e{i}@f.io, g{i}@h.io now") for i in range(1000)]
    rows += [(2000 + i, f"order 1234 5678 9012 3456 of 2024-03-{10 + i % 20} and 1939-1945 in{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find_personal(docs).collect()}
    assert all(found[i] == ["email"] * 4 for i in range(1000))
    assert all(found[2000 + i] == [] for i in range(40))


def test_loose_candidates_are_reported_in_a_shared_form(spark):
    rows = [(i, f"write to a{i}@b{i % 7}.org or call +1 (212) 555-{1000 + i} today") for i in range(1000)]
    rows += [(2000, "ask anna (at) example (dot) org please"), (2001, "call (212) 555-9876 now"), (2002, "x (at) -y dot c now"),
             (2003, "ANNA [at] Example dot co dot uk"), (2004, "in 2024-03-10 12 or 1939-1945"), (2005, "room 212 555 98")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = {i: t for i, t in rows}
    found = {r["doc_id"]: [(s["kind"], text[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"]]
             for r in pii.find_personal(docs).collect()}
    assert all([k for k, _ in found[i]] == ["email", "phone"] for i in range(1000))
    assert found[2000] == [("spelled", "anna (at) example (dot) org")] and found[2001] == [("number", "(212) 555-9876")]
    assert found[2003] == [("spelled", "ANNA [at] Example dot co dot uk")]
    assert found[2002] == found[2004] == found[2005] == []


def test_refuted_numbers_keep_a_format_out(spark):
    # As many card numbers without a check digit as phone numbers of the same format: nothing vouches for the format.
    rows = [(i, f"call +12 1234 5678 9012 {i:03d} today") for i in range(600)]
    rows += [(1000 + i, f"order 1234.5678.9012.{i:04d}, on 2024-03-1{i % 10} {i % 900 + 100}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["spans"] if not s["strict"]] for r in pii.find_personal(docs).collect()}
    assert not any(found.values())


def test_an_address_is_checked_more_closely_than_it_is_reported(spark):
    shown = spark.createDataFrame([("a@b.org a..b@c.d1",)], "t string").select(pii.candidates(F.col("t")).alias("c")).first()["c"]
    assert [(s["kind"], s["confirmed"], s["label"]) for s in shown] == [("email", True, True), ("email", True, False)]


def test_each_group_has_its_own_threshold():
    cell = dict.fromkeys(pii.FEATURES, 0)
    cells = [
        cell | {"shape": shape, "confirmed": yes, "held": held, "n": n}
        for held in (False, True) for shape, yes, n in ((0, True, 9000), (4, True, 30), (4, False, 70))]
    model = pii.fit(cells)
    assert set(model.thresholds) == {pii._group(cell)}


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é mail me@a.io now"), (2, None)], "doc_id bigint, text string")
    found = pii.find_personal(docs).join(docs, "doc_id")
    shown = {r["doc_id"]: r["t"] for r in found.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert shown[1] == "é mail [email] now"


def test_quality_of_the_corpus(spark, texts):
    for r in queries.op7_quality_rules(spark, FOLDER).collect():
        plain = brute.quality(texts[r["doc_id"]])
        assert {k: r[k] for k in plain} == plain
        assert not (r["base_failed"] and r["kept"])


def test_quality_of_odd_rows(edge_docs):
    entries = quality_rules.ledger(edge_docs)
    assert entries.columns == [*edge_docs.columns, "measures"]
    got = [(r["doc_id"] or -1, r["measures"]["n_words"], r["measures"]["n_repeat_words"]) for r in entries.collect()]
    want = [(i or -1, q["n_words"], q["n_repeat_words"]) for i, t in EDGES for q in [brute.quality(t)]]
    assert sorted(got) == sorted(want)
    kept = quality_rules.passing(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set()


def test_many_different_words_are_counted_exactly():
    words = [b"w%d" % i for i in range(1_100_000)] + [b"w1", b"w2", b"w3"]
    assert quality_rules._repeated(words) == 6


def test_ablation(corpus):
    entries = quality_rules.ledger(corpus.select("doc_id", "text")).collect()
    got = {r["rule"]: (r["failed"], r["only_this"]) for r in quality_rules.ablation(quality_rules.ledger(corpus)).collect()}
    names = [r.name for r in quality_rules.RULES]
    for name, (failed, only) in got.items():
        bit = 1 << names.index(name)
        assert failed == sum(bool(e["failed"] & bit) for e in entries)
        assert only == sum(e["failed"] & quality_rules.policy_mask(quality_rules.POLICY) == bit for e in entries)


def test_ablation_is_a_query(spark, corpus):
    got = {r["rule"]: (r["failed"], r["only_this"]) for r in queries.QUERIES["op7_rule_ablation"](spark, FOLDER).collect()}
    want = quality_rules.ablation(quality_rules.ledger(corpus)).collect()
    assert got == {r["rule"]: (r["failed"], r["only_this"]) for r in want} and len(got) == len(quality_rules.RULES)


@pytest.mark.parametrize("run", [secret_scan.scan, pii.find_personal, quality_rules.ledger, quality_rules.passing])
def test_empty_table(no_docs, run):
    assert run(no_docs).count() == 0
