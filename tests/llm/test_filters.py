"""Toxicity, benchmark passages and archives: planted cases, plain matching, edge cases."""

import base64
import gzip
import hashlib
import random

import duckdb
import pytest

from rowmill.llm.decontaminate import decontaminated, passages
from rowmill.llm.decontaminate_queries import PASSAGES_SQL
from rowmill.llm.toxicity import ToxicityModel, fit_toxicity, fold, measure, not_toxic, sample_labelled, toxicity
from rowmill.llm.warc import IndexReader, archive_pages, lookups, parse_record, read_records, record, url_key


def words(n, draw, prefix="w"):
    return [f"{prefix}{draw.randrange(3000)}" for _ in range(n)]


@pytest.mark.parametrize("least,text,found", [
    (40, "copy", True), (40, "substituted", True), (40, "half", True), (40, "clean", False), (40, "few", False),
    (12, "copy", True), (11, "few", False), (8, "copy", True), (8, "one", True), (8, "substituted", False), (6, "one", True), (5, "one", False), (4, "copy", True), (2, "copy", True), (1, "copy", False),
])
def test_planted_passages(spark, least, text, found):
    draw = random.Random(least)
    item = words(least, draw, "q")
    inside = {"copy": item, "substituted": [w if i % 6 else "other" for i, w in enumerate(item)], "half": item[: least // 2], "clean": [], "few": item[:8], "one": [w if i != least // 2 else "other" for i, w in enumerate(item)]}[text]
    body = words(5000, draw) + [w.upper() + "," for w in inside] + words(300, draw)
    docs = spark.createDataFrame([(1, " ".join(body), "a"), (2, " ".join(words(200, draw)), "b")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, " ".join(item), "x"), (8, " ".join(words(30, draw, "z")), "y")], "item_id long, text string, doc_id string")
    got = passages(docs, bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == ([(1, 7)] if found else [])
    if found:
        assert got[0].place == 5000 and got[0].item_words == least
    assert decontaminated(docs, bench).count() == (1 if found else 2) and decontaminated(docs, bench).columns == docs.columns


def test_short_items_and_scripts_without_spaces(spark):
    items = [(1, "the capital of france"), (2, "what is the boiling temperature of water"), (3, "日本の首都は東京です。"), (4, "日本"), (5, "Paris")]
    texts = ["Well, The Capital of France: see", "so what is the boiling point of water then", "昨日、日本の首都は東京ですと", "the capital city of france, Paris", "what is a boiling point of water", "日 本"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.equal_words, r.place) for r in passages(docs, bench).collect())
    assert got == [(0, 1, 4, 1), (1, 2, 6, 1), (2, 3, 10, 2), (2, 4, 2, 2), (5, 4, 2, 0)]
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    connection.register("benchmark", bench.toPandas())
    sql = connection.sql(PASSAGES_SQL).fetchall()
    assert sorted((d, i, equal, place) for d, i, _, equal, place in sql) == got


@pytest.mark.parametrize("seeds,hashes", [(0, 10**6), (0, 0)])
def test_large_benchmarks_are_merged(spark, monkeypatch, seeds, hashes):
    docs = spark.createDataFrame([(i, " ".join(words(60, random.Random(i % 7)))) for i in range(20)] + [(30, "one two three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words(60, random.Random(3))[10:40])), (2, "two three four")], "item_id long, text string")
    want = sorted(map(tuple, passages(docs, bench).drop("digest").collect()))
    monkeypatch.setattr("rowmill.llm.decontaminate.BROADCAST_SEEDS", seeds)
    monkeypatch.setattr("rowmill.llm.decontaminate.BROADCAST_HASHES", hashes)
    assert sorted(map(tuple, passages(docs, bench).drop("digest").collect())) == want and len(want) == 4


def test_passages_edge_cases(spark):
    draw = random.Random(9)
    item = " ".join(words(20, draw, "q"))
    rows = [(None, item), (1, None), (2, ""), (3, item), (3, item), (3, "clean words here"), (4, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (2, None), (3, ""), (4, item)], "item_id long, text string")
    assert sorted((str(r.doc_id), str(r.item_id)) for r in passages(docs, bench).collect()) == [("3", "4"), ("3", "None"), ("None", "4"), ("None", "None")]
    assert sorted(str(r.doc_id) for r in decontaminated(docs, bench).collect()) == ["1", "2", "3", "4"]
    assert passages(docs.limit(0), bench).count() == 0 and passages(docs, bench.limit(0)).count() == 0


def test_fold():
    assert fold("1D10T! ɡօ0d").split() == ["idiot", "good"]
    assert fold("іdіот $cum t@x m0r0n$").split() == ["idiot", "cum", "tax", "moron"]
    assert fold("Ｆｕｌｌ ①") .split()[0] == "full" and fold(None) == ""


def test_matching_is_by_word_and_exception():
    model = ToxicityModel({" idiot ": 3.0, " trash ": 2.0, " foo": 1.0}, ("trash can",), ())
    m = model.matcher()
    assert measure(m, "An 1DIOT, idiotic; the trash can. Trash!") == (5.0, 2, 7)
    assert measure(m, "foobar food xfoo") == (2.0, 2, 3)
    assert measure(m, None) == (0.0, 0, 0) and measure(None, "a b") == (0.0, 0, 2)


def test_learned_lexicon(spark):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        w = words(60, draw)
        for _ in range(2 * toxic):
            w[draw.randrange(60)] = draw.choice(["grumble", "snark", "blether" + draw.choice("abcdefgh")])
        rows.append((i, " ".join(w), "x", 1))
        labels.append((i, int(toxic)))
    rows += [(2000, None, "x", 1), (2001, "", "x", 1), (None, "a GRUMBL3 here", "x", 1), (2002, "no labels, but gгumble twice: grumble", "x", 1), (2003, " ".join(words(4000, draw)), "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, hits int")
    labelled = spark.createDataFrame([*labels, (1, None), (None, 1), (8, 1)], "doc_id long, toxic int")
    model = fit_toxicity(sample_labelled(docs, labelled))
    assert {t.strip()[:6] for t in model.terms} >= {"grumbl", "snark", "blethe"}
    got = {r.kept: r for r in toxicity(docs, model).collect()}
    assert len(got) == len(rows)
    wrong = [i for i, t in labels if got[i].predicted != t]
    assert not wrong
    assert got[None].predicted == got[2002].predicted == 1 and got[2000].predicted == got[2001].predicted == got[2003].predicted == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = not_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    assert toxicity(docs.limit(0), model).count() == 0


def test_repeated_ids_of_labels(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(3)] * 2, "doc_id long, toxic int")
    drawn = [sorted(r.text for r in sample_labelled(docs.repartition(n), labels, 2).collect()) for n in (1, 5)]
    assert drawn[0] == drawn[1] and len(drawn[0]) <= 2


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0), (2, 0)]):
        model = fit_toxicity(sample_labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
        assert [(r.score, r.predicted) for r in toxicity(docs, model).collect()] == [(0.0, 0)] * 2


def test_record_round_trip():
    payload = "a\r\n\r\nb é".encode()
    got = parse_record(record(5, "http://x/ y", payload, None, False, "2000-01-01T00:00:00Z"))
    assert (got["page_id"], got["payload"], got["length"], got["type"], got["refers_to"]) == (5, payload, len(payload), "response", None)
    got = parse_record(record(None, None, payload, 5, True, "2000-01-01T00:00:00Z"))
    assert (got["page_id"], got["payload"], got["length"], got["type"], got["refers_to"]) == (None, None, len(payload), "revisit", 5)
    assert url_key("https://www.B.example.com:8080/p?q=1#top") == "com,example,b)/p?q=1" and url_key(None) == ""


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("rowmill.llm.warc.BLOCK_LINES", 7)
    rows = [(i, f"http://h{i % 3}.org/{i % 50}", f"<p>{i % 60}</p>" + "é" * (i % 7), "x") for i in range(200)]
    rows += [(None, None, None, "x"), (300, "odd url", "", "x"), (301, "http://h0.org/0", "<p>0</p>", "x"), (5, "http://again.org/", rows[5][2], "x"), (400, "http://big.org/", "z" * 2_000_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string")
    captures, files = archive_pages(spark, pages, str(tmp_path / "w"))
    got = read_records(captures, str(tmp_path / "w"), files).collect()
    assert len(got) == len(rows)
    first = {}
    for p, _, h, _ in rows:
        h = h or ""
        first[h] = min(first.get(h, 1 << 62), 1 << 62 if p is None else p)
    want = []
    for p, u, h, _ in rows:
        data = (h or "").encode()
        same = first[h or ""] == (1 << 62 if p is None else p)
        want.append((str(p), u or "", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if same else "revisit", str(None if same else first[h or ""])))
    assert sorted((str(r.page_id), r.url or "", r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == sorted(want)
    assert all(bytes(r.payload).decode() == {p: h or "" for p, _, h, _ in rows}[r.page_id] for r in got if r.record_type == "response")
    reader = IndexReader(str(tmp_path / "w"), [(r.first_key, r.file) for r in files.collect()])
    assert len(list(reader.captures("org,h0)/0"))) == sum(u == "http://h0.org/0" for _, u, _, _ in rows)
    assert list(reader.captures("org,nobody)/")) == [] and list(reader.captures("")) != []
    one = next(reader.captures("org,big)/"))
    raw = gzip.decompress(reader.read(*one[2:]))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response") and raw.endswith(b"\r\n\r\n")


def test_small_payloads_and_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "xy"), (2, "http://b/", "xy"), (3, "http://c/", "long enough"), (4, "http://d/", "long enough")], "page_id long, url string, html string")
    captures, files = archive_pages(spark, pages, str(tmp_path / "w"), least_bytes=5)
    assert {r.page_id: r.refers_to for r in read_records(captures, str(tmp_path / "w"), files).collect()} == {1: None, 2: None, 3: None, 4: 3}
    captures, files = archive_pages(spark, pages.limit(0), str(tmp_path / "none"))
    assert captures.count() == files.count() == read_records(captures, str(tmp_path / "none"), files).count() == 0


def test_a_url_of_a_third_of_all_pages_is_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("rowmill.llm.warc.BLOCK_LINES", 7)
    monkeypatch.setattr("rowmill.llm.warc.READ_BYTES", 8_000)
    rows = [(i, None if i % 3 == 0 else "http://same.org/" if i % 3 == 1 else f"http://h{i}.org/", f"page {i}") for i in range(300)]
    captures, files = archive_pages(spark, spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    wanted, tasks = lookups(captures)
    pieces = wanted.collect()
    assert tasks > 4 and max(r.end - r.begin for r in pieces) <= 300 // tasks + 1
    got = read_records(wanted, str(tmp_path / "w"), files, tasks=tasks)
    assert got.rdd.getNumPartitions() == tasks
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got.collect()) == [(i, h) for i, _, h in rows]
    reader = IndexReader(str(tmp_path / "w"), [(r.first_key, r.file) for r in files.collect()])
    every = list(reader.captures("org,same)/"))
    assert len(every) == 100 and [list(reader.captures("org,same)/", a, a + 9)) for a in range(0, 100, 9)] == [every[a : a + 9] for a in range(0, 100, 9)]
