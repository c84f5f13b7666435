"""Each operator against a brute-force version, with nulls, empty texts, repeats, clashing columns and empty tables."""

import collections
import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedfold.llm import embedding_dedup, exact_dedup, licenses, mixing, near_dedup, packing, quality, substring_dedup, toxicity, warc
from feedfold.llm.common import components, stage, with_group
from feedfold.llm.queries import RANKS, TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = ("doc_id", "start_word", "n_words", "first_doc_id", "first_start", "similarity")
ODD = "doc_id long, text string, source string, `row` long, `Score` int, `_salt` int, `held.x` string, `component` long"


def docs_of(spark, rows):
    """(doc_id, text) or (doc_id, text, source) rows as documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_docs(spark, rows):
    return spark.createDataFrame([(d, t, "s", 1, 2, 3, "x", 4) for d, t in rows], ODD)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(text, seed, k):
    rng, w = random.Random(seed), text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def rows_of(frame, *cols):
    return sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=repr)


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_and_group_values(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5)] + [(100, i) for i in range(101, 140)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    want = {n: c for n, c in classes({n for p in links for n in p}, links).items() if n != 5}
    assert dict(rows_of(got, "node", "component")) == want
    frame = spark.createDataFrame([(i % 3, i) for i in range(30)], "k long, v long")
    out = with_group(frame, ["k"], ["v"], {"m": F.min("v"), "n": F.count("*")}, salts=4)
    assert rows_of(out, "k", "v", "m", "n") == sorted(((i % 3, i, i % 3, 10) for i in range(30)), key=repr)


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup(spark, bits):
    long = prose(1, 3000)
    rows = [(1, "a b"), (2, "ab"), (3, " a b "), (4, None), (5, ""), (6, " \n"), (7, long), (8, long + " x"), (9, long.replace(" ", "\n")), (10, "x" + long), (11, "é "), (11, "é"), (None, "q"), (12, "q"), (13, "ab"), (13, "ab")]
    docs = odd_docs(spark, rows)
    group = collections.defaultdict(list)
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    for d, t in rows:
        group[norm(t)].append((-len(t or ""), d is None, d or 0, d))
    got = exact_dedup.exact_duplicates(docs, block_bytes=64, bits=bits).collect()
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(group)
    shas = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in group.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == (min(shas[r["text_sha256"]])[3], len(shas[r["text_sha256"]]))
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(group)
    assert exact_dedup.exact_duplicates(docs.where("false")).count() == 0


def test_near_dedup_equals_brute_force(spark):
    base = prose(2, 150)
    rows = [(i, edited(base, i, i % 9)) for i in range(40)] + [(100 + i, prose(50 + i, 60)) for i in range(10)]
    chain = prose(3, 120)
    for i in range(12):
        rows.append((200 - i, chain))
        chain = edited(chain, i, 3)
    rows += [(300, None), (301, ""), (302, "One two"), (303, "one\ttwo"), (304, "two one"), (None, base), (5, prose(99, 50)), (400, prose(99, 50))]
    got = near_dedup.near_duplicates(odd_docs(spark, rows))
    named = [(d, near_dedup.shingle_set(t)) for d, t in rows if d is not None]
    links = [(a, b) for i, (a, x) in enumerate(named) for b, y in named[:i] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    want = classes({d for d, _ in named}, links)
    for r in got.where("doc_id IS NOT NULL").collect():
        assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert sorted(r["n_shingles"] for r in got.collect()) == sorted(len(near_dedup.shingle_set(t)) for _, t in rows)
    assert near_dedup.drop_near_duplicates(odd_docs(spark, rows)).count() == len(set(want.values())) + 1
    assert near_dedup.near_duplicates(docs_of(spark, []).where("false")).count() == 0


def test_near_dedup_tests_the_short_text_of_a_repeated_id(spark):
    w = [f"w{i}" for i in range(160)]
    lead, x, short = " ".join(w), " ".join(w[:100]), " ".join(w[:90])
    texts = docs_of(spark, [(1, x), (2, short), (2, prose(9, 3000)), (3, lead), (4, lead)])
    shared = spark.createDataFrame([(7, 1, 3), (7, 2, 3), (7, 3, 3), (8, 3, 2), (8, 4, 2)], "bucket long, doc long, n long")
    links = near_dedup._linked(shared, texts, 4, 80).collect()
    assert classes(range(1, 5), [tuple(r) for r in links])[2] == 1


def test_near_dedup_does_not_pair_rows_that_share_a_passage_only(spark, monkeypatch):
    base, passage = prose(2, 140), " ".join(f"p{i}" for i in range(16))
    rows = [(1, base)] + [(i, f"{edited(base, i, 14)} {passage}") for i in range(10, 70)]
    rows += [(d + 100, edited(t, d, 2)) for d, t in rows[1:60:6]]
    counted, stage = [], near_dedup.stage

    def counting(frame, name):
        out = stage(frame, name)
        if name == "pairs":
            counted.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "stage", counting)
    # bucket 7 holds all rows, the others make the first row the most central one
    shared = [(7, d, len(rows)) for d, _ in rows] + [(8, 1, 9), (9, 1, 9)]
    links = near_dedup._linked(spark.createDataFrame(shared, "bucket long, doc long, n long"), docs_of(spark, rows), 4, 80).collect()
    sets = [(d, near_dedup.shingle_set(t)) for d, t in rows]
    want = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if 100 * len(x & y) >= 80 * len(x | y)]
    nodes = [d for d, _ in rows]
    assert len(want) >= 10 and classes(nodes, [tuple(r) for r in links]) == classes(nodes, want)
    assert sum(counted) <= 5 * len(rows), counted  # 70 rows have 2,415 pairs


def test_packing_is_a_gapless_round_trip(spark):
    from tokenizers import Tokenizer

    rows = [(i, prose(i, 50 + 17 * i)) for i in range(30)] + [(50, None), (51, ""), (52, "a  b   c\n  d \t e <|endoftext|> naïve 日本"), (53, prose(7, 20000)), (3, "again"), (None, "nameless")]
    tok = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter((d, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (1,)) for d, t in rows)
    pieces = packing.pack(odd_docs(spark, rows), TOKENIZER, 256).collect()
    at = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * 256 + p["offset"] == at and len(p["ids"]) == 4 * p["length"]
        at += p["length"]
    texts, run = collections.Counter(), b""
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["start"] * 4 == len(run)
        run += p["ids"]
        if len(run) == 4 * p["doc_tokens"]:
            texts[p["doc_id"], tuple(int(x) for x in np.frombuffer(run, "<u4"))] += 1
            run = b""
    assert texts == want and not run
    assert all(r["ids_crc32"] == zlib.crc32(p["ids"]) for r, p in zip(*(sorted(x, key=lambda r: (r["sequence_id"], r["offset"])) for x in (packing.digests(spark.createDataFrame(pieces)).collect(), pieces))))
    assert packing.pack(docs_of(spark, []), TOKENIZER).count() == 0


def test_rank_file_gives_the_ids_of_the_tokenizer(spark):
    slow, fast, rng = packing.Tokens(TOKENIZER), packing.Tokens(TOKENIZER, RANKS), random.Random(8)
    signs = [" ", "a", "é", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", ".", "'s", "'LL", "1", "²", "日", "x", "\r", "<|endoftext|>", "👍🏽", "\u0301", "\u200d", "\x00", "Ⅷ", "٣"]
    texts = ["", " " * 3000, "a" * 3000, prose(4, 500), " \n" * 500, *("".join(rng.choices(signs, k=rng.randrange(15))) for _ in range(2000))]
    assert all(fast.ids(t).tolist() == slow.ids(t).tolist() for t in texts)
    docs = docs_of(spark, [(i, t) for i, t in enumerate(texts[:300])] + [(None, None)])
    both = [rows_of(packing.pack(docs, TOKENIZER, 64, ranks=r), "sequence_id", "offset", "doc_id", "ids") for r in (None, RANKS)]
    assert both[0] == both[1]


def test_word_scores_do_not_depend_on_what_is_cached(spark, monkeypatch):
    rng = random.Random(2)
    signs = list("abcdefgh-,.!é日👍<> ") + ["\ud800"]
    words = ["".join(rng.choices(signs, k=rng.randrange(1, 14))) for _ in range(2000)] + ["a", "", ".", "x" * 64]
    rows, sizes = toxicity.gram_rows(words)
    assert [r.tolist() for r in np.split(rows, np.cumsum(sizes)[:-1])] == [toxicity.ngrams(w) for w in words]
    model = toxicity.Model(np.random.default_rng(1).normal(0, 1, toxicity.ROWS), 0.5)
    texts = [None, "", *(prose(i, 40, 900) for i in range(300))]
    whole = model.scores(texts, {})
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 50)
    cache = {}
    assert [x for at in range(0, len(texts), 7) for x in model.scores(texts[at : at + 7], cache)] == whole
    want = max(np.mean([model.weights[toxicity.ngrams(w)].mean() for w in texts[5].split()[i : i + toxicity.WINDOW]]) for i in range(37))
    assert abs(whole[5] - 1 / (1 + np.exp(-want - 0.5))) < 1e-9


def test_packing_a_mix_keeps_source_shares_in_every_run(spark):
    rows = [(i, f"{'abc'[i % 3]} " * 60, "abc"[i % 3]) for i in range(1800)]  # a source's texts are neighbours on the curve
    source = {r[0]: r[2] for r in rows}
    pieces = packing.pack(docs_of(spark, rows), TOKENIZER, 256, mixed=True, run_slots=9).collect()
    last = max(p["sequence_id"] for p in pieces)
    for at in range(5):
        held = collections.Counter()
        for p in pieces:
            if p["sequence_id"] * 5 // (last + 1) == at:
                held[source[p["doc_id"]]] += p["length"]
        assert all(0.2 < n / sum(held.values()) < 0.47 for n in held.values()) and len(held) == 3


def test_hilbert_neighbours_touch():
    grid = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    path = grid[np.argsort(packing.hilbert(grid, 3))]
    assert sorted(packing.hilbert(grid, 3)) == list(range(512))
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_mixing_keeps_every_row_and_stays_within_a_block(spark):
    sizes = {"a": 400, "b": 130, "c": 60, None: 25}
    rows = [(n * 1000 + i, f"t{i}", s) for n, (s, k) in enumerate(sizes.items()) for i in range(k)] + [(None, None, "a"), (1, "t1", "a")]
    docs = docs_of(spark, rows)
    weights = {"a": 0.5, "b": 0.3, "c": 0.15, None: 0.05}
    got = mixing.mix(docs, weights, block_rows=5, period=100).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in rows)
    slots = collections.defaultdict(set)
    for r in got:
        slots[r["slot"]].add((r["stream"], r["block"]))
    assert sorted(slots) == list(range(len(slots))) and all(len(v) == 1 for v in slots.values())
    shares, seen = mixing.whole_shares(weights, 100), collections.Counter()
    assert sum(shares.values()) == 100
    for t in range(60):  # no source ends before
        seen[next(iter(slots[t]))[0]] += 1
        for s, a in shares.items():
            assert abs(seen[s] - a * (t + 1) / 100) < 1
    assert rows_of(mixing.mixed_rows(docs), "doc_id", "text") == sorted(((r[0], r[1]) for r in rows), key=repr)
    assert mixing.mixed_rows(odd_docs(spark, [(1, "a"), (2, None)])).columns == odd_docs(spark, [(1, "a")]).columns
    assert mixing.mix(docs.where("false")).count() == 0


def streams_by_slot(rows):
    by_slot = {r["slot"]: r["stream"] for r in rows}
    assert sorted(by_slot) == list(range(len(by_slot)))
    return [by_slot[t] for t in range(len(by_slot))]


def test_mixing_schedules_each_of_many_sources(spark):
    equal = docs_of(spark, [(n * 100 + i, "t", f"s{n}") for n in range(300) for i in range(4)])
    slots = streams_by_slot(mixing.mix(equal, block_rows=1).collect())
    for t in range(0, len(slots), 300):
        assert len(set(slots[t : t + 300])) == 300
    rare = docs_of(spark, [(i, "t", "big") for i in range(1000)] + [(2000 + i, "t", "rare") for i in range(4)])
    slots = streams_by_slot(mixing.mix(rare, {"big": 0.7, "rare": 0.3}, block_rows=1).collect())
    assert [t for t, s in enumerate(slots) if s == "rare"][-1] < 14


def test_mixing_keeps_to_the_given_weights_over_a_long_table(spark):
    weights = {"a": 0.50013, "b": 0.29987, "c": 0.15, None: 0.05}
    docs = spark.range(60000).selectExpr("id AS doc_id", "CASE WHEN id % 10 < 5 THEN 'a' WHEN id % 10 < 8 THEN 'b' WHEN id % 20 < 19 THEN 'c' END AS source")
    slots = streams_by_slot(mixing.mix(docs, weights, block_rows=2).select("slot", "stream").distinct().collect())
    seen = collections.Counter()
    for t, s in enumerate(slots[:29000]):  # no source ends before
        seen[s] += 1
        assert all(abs(seen[k] - w * (t + 1)) < 1 for k, w in weights.items())


def test_toxicity_learns_words_and_their_misspellings(spark):
    bad = ["venomous", "wretched", "horrible"]
    rows, labels = [], []
    for i in range(300):
        w = prose(i, 60, 3000).split()
        if i % 4 == 0:
            w[10] = bad[i % 3]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, prose(1, 200) + " venomus " + prose(2, 200)), (903, prose(4, 20000)), (None, "x"), (0, "again")]
    table = spark.createDataFrame(labels + [(5, None, None), (6, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(odd_docs(spark, rows), table).collect()}
    held = [i for i in range(1, 300) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.9
    assert got[902]["score"] > 0.7 and got[900]["score"] == got[901]["score"] < 0.7 and got[903]["predicted"] == 0
    kept = toxicity.drop_toxic(odd_docs(spark, rows), table)
    assert kept.columns == odd_docs(spark, rows).columns and 902 not in {r["doc_id"] for r in kept.collect()}
    assert toxicity.toxicity(docs_of(spark, []), table).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(docs_of(spark, rows), table.where("false")).collect()} == {0}


def test_toxicity_is_not_trained_in_the_driver(spark, monkeypatch):
    import os

    docs = docs_of(spark, [(i, f"w{i} bad" if i % 2 else f"w{i}") for i in range(40)] + [(None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    whole = toxicity.fit(docs, labels)
    texts = {i: t for i, t in docs.select("doc_id", "text").collect()}
    taught = [r[0] for r in labels.where(~toxicity.is_held_out()).orderBy(F.xxhash64("doc_id", F.lit(17))).collect()]
    own = toxicity.train([texts[i] for i in taught], [i % 2 for i in taught])
    assert whole.bias == own.bias and (whole.weights == own.weights).all()
    assert not toxicity.fit(docs, labels.where("false")).weights.any()

    def where_trained(texts, labels):
        return toxicity.Model(np.zeros(len(list(texts)), np.float32), float(os.getpid()))

    monkeypatch.setattr(toxicity, "train", where_trained)
    model = toxicity.fit(docs, labels)
    assert len(model.weights) == len(taught) and model.bias != os.getpid()


def test_toxicity_reads_all_of_a_long_run():
    grams = lambda text: {g for w in toxicity.words_of(text) for g in toxicity.ngrams(w)}
    run = "".join(chr(0x4E00 + k * 7 % 5000) for k in range(400))
    for at in range(len(run) - 5):
        assert zlib.crc32(run[at : at + 6].encode()) % toxicity.ROWS in grams(run)
    weights = np.full(toxicity.ROWS, -1.0)
    weights[toxicity.ngrams("venomous")] = 9.0
    model, clean = toxicity.Model(weights, 0.0), ",".join(["harmless"] * 20)
    assert model.score(clean, {}) < 0.5 < model.score(f"{clean},venomous", {})
    assert toxicity.words_of("-" * 100) and toxicity.words_of("Short, text") == ["short,", "text"]


def test_quality_discriminant(spark):
    rows = [(i, prose(i, 80) if i % 3 else prose(i, 80).upper().replace(" ", "!! ")) for i in range(200)]
    table = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = odd_docs(spark, [*rows, (900, None), (901, ""), (902, prose(5, 20000)), (None, "x")])
    got = {r["doc_id"]: r for r in quality.quality(docs, table).collect()}
    assert all(got[i]["predicted"] == (i % 3 > 0) for i in range(200)) and got[900]["score"] == got[901]["score"]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(200))
    assert quality.quality(docs.where("false"), table).count() == 0
    assert quality.quality(docs, table.where("quality = 1")).count() == 204


def test_warc_round_trip(spark):
    same, other = "é" * 60 + "\r\n\r\nWARC/1.1\r\n\r\n", "x" * 99
    rows = [(5, "http://a/1", same), (2, "http://a/2", same), (9, None, same), (3, "u\r\nX: y", other), (4, "u", other), (6, "u", None), (7, "u", ""), (8, "u", "z" * 300000), (8, "u", "z" * 300000), (None, "u", "n" * 200)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, `at` int")
    want = []
    for p, _, html in rows:
        data = (html or "").encode()
        firsts = [q for q, _, h in rows if h == html and q is not None]
        first = min(firsts) if firsts and len(data) >= 100 else p
        want.append((p, len(data), hashlib.sha256(data).hexdigest(), "response" if p in (first, None) else "revisit", None if p in (first, None) else first))
    assert rows_of(warc.round_trip(pages), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_each_revisit_names_a_response_of_the_archives(spark, tmp_path):
    body = "<p>" + "x" * 200
    rows = [(i, f"http://h/{i}", body if i % 3 else f"{body}{i}") for i in range(90)] + [(1, "again", body)] * 300 + [(2, "u", body), (None, "u", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    warc.write_archives(pages, str(tmp_path / "a"), 4096)
    records = warc.read_archives(spark, str(tmp_path / "a")).collect()
    ids = [r["record_id"] for r in records]
    assert len(ids) == 3 * len(rows) == len(set(ids))
    responses = {r["record_id"]: r["payload"] for r in records if r["type"] == "response"}
    revisits = [r for r in records if r["type"] == "revisit"]
    assert len(revisits) == 60 - 1 + 1 and all(responses[r["refers_to"]] == body for r in revisits)
    sizes = [f.stat().st_size for f in (tmp_path / "a").glob("*.gz")]
    assert len(sizes) > 4  # rows that repeat one page are spread over archives


def test_a_large_record_is_read_in_linear_time(spark):
    import gzip
    import time

    def seconds(mb):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + b"ab" * (mb << 19)
        record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
        data, began = gzip.compress(record, 1) * 2, time.thread_time()
        assert [len(b) for _, b in warc._records(data)] == [len(block)] * 2
        return time.thread_time() - began

    small, large = min(seconds(16) for _ in range(2)), seconds(128)
    assert large < 24 * max(small, 0.02)


def test_license_notices(spark):
    mit = licenses.TEMPLATES["mit-permission"]
    rows = [(1, f"{prose(1, 90)}. {mit}. {prose(2, 90)}"), (2, "Licensed under the Apache License, Version 2.0."), (3, " ".join(mit.split()[:9])), (4, "All rights reserved. " * 3), (5, None), (6, ""), (7, prose(3, 20000)), (2, "Licensed under the Apache License, Version 2.0."), (None, "Released under the MIT License.")]
    got = rows_of(licenses.license_notices(odd_docs(spark, rows)), "doc_id", "license")
    assert got == sorted([(1, "mit-permission"), (2, "apache-2.0"), (2, "apache-2.0"), (4, "all-rights-reserved"), (None, "mit")], key=repr)
    assert licenses.license_notices(docs_of(spark, [])).count() == 0 and licenses.license_notices(docs_of(spark, rows), {}).count() == 0


def test_a_passage_that_no_lead_holds(spark):
    rng = random.Random(58)  # all keys that the two near texts share are the first one's, too, which is unlike both
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    text = [word() for _ in range(60)]
    edited = lambda places: " ".join(word() if i in places else w for i, w in enumerate(text))
    docs = docs_of(spark, list(enumerate([edited([12, 24, 46]), " ".join(text), edited([32])], 1)))
    got = substring_dedup.repeated_passages(docs, rounds=1).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in got} == {(2, 2), (3, 2)}


def test_texts_that_share_short_lines_only_get_no_windows(spark):
    line = prose(950, 13, 10**6)  # a passage keeps 24 words in a row
    rows = [(i, f"{prose(i, 60, 10**6)} {line} {prose(100 + i, 60, 10**6)}") for i in range(40)]
    shared = prose(951, 60, 10**6)
    rows += [(100 + i, f"{prose(200 + i, 60, 10**6)} {shared} {prose(300 + i, 60, 10**6)}") for i in range(2)]
    assert {r["doc_id"] for r in substring_dedup.anchors(docs_of(spark, rows)).select("doc_id").collect()} == {100, 101}


def test_no_passage_lies_where_the_bound_rules_it_out():
    rng, ruled, tried, plain = np.random.default_rng(9), 0, 0, substring_dedup.passage
    for trial in range(300):
        n, words = int(rng.integers(46, 250)), (60, 400, 10**6)[trial % 3]  # repeats are frequent, some, none
        own = rng.integers(0, words, n).astype(np.uint64)
        other = own
        for _ in range(int(rng.integers(0, 2 + n // 15))):
            k, put, cut = (int(x) for x in rng.integers((0, 4, 4), (len(other), 7, 7)))
            other = np.concatenate((other[:k], rng.integers(0, words, put).astype(np.uint64), other[k + cut :]))
        if len(other) < 46:
            continue
        by, back = substring_dedup.Places(own, other), substring_dedup.Places(other, own)
        at = np.flatnonzero(np.isin(own, other))[::9]
        there = np.array([np.flatnonzero(other == own[a])[0] for a in at], int)
        for a, b, *may in zip(at.tolist(), there.tolist(), *by.may_reach(at, there, 46)):
            assert may[0] or not plain(own, other, a, b, 46, by)
            assert may[1] or not plain(other, own, b, a, 46, back)
            ruled, tried = ruled + (not may[0]), tried + 1
    assert 0 < ruled < tried


def test_best_parts_are_those_of_all_parts():
    rng = np.random.default_rng(6)
    for n in (5, 12, 13, 30, 70):
        total = np.concatenate(([0], np.cumsum(rng.choice([1, -8], n, p=[0.85, 0.15]))))
        got = substring_dedup.best_parts(total[:-1], total[1:], 12)
        for at in range(n if n >= 12 else 0):
            assert got[at] == max(total[j] - total[i] for i in range(at + 1) for j in range(at + 1, n + 1) if j - i >= 12)


def test_windows_of_joined_parts_are_those_of_each():
    rng = np.random.default_rng(8)
    odd = np.random.default_rng(5).integers(0, 1 << 63, substring_dedup.HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    parts = [rng.integers(0, v, n).astype(np.uint64) for n, v in ((46, 9), (200, 10**6), (47, 10**6), (300, 40))]
    number, *joined = substring_dedup.windows_of(np.concatenate(parts), np.array([len(p) for p in parts]), 46, odd)
    for k, part in enumerate(parts):
        alone = substring_dedup.keyed_windows(part, 46, odd)
        assert len(alone[0]) and all(np.array_equal(j[number == k], a) for j, a in zip(joined, alone))


def test_exact_passages_start_where_all_runs_are_shared():
    starts = substring_dedup.exact_starts(np.array([*range(5, 40), *range(60, 80), *range(90, 117)]), 46)  # a run has 20 shingles
    assert starts.tolist() == [*range(5, 14), 90]
    assert substring_dedup.spans(starts).tolist() == [5, 13, 90, 90] and not len(substring_dedup.spans(starts[:0]))


def test_a_pair_of_passages_is_tested_once(spark, monkeypatch):
    asked, verified = [], substring_dedup._verified
    monkeypatch.setattr(substring_dedup, "_verified", lambda rows, *more: asked.append(rows.select("doc_id").distinct().count()) or verified(rows, *more))
    rows = []
    for k in range(6):  # three pairs hold a passage, three a part of one, which all four keys may know
        shared = prose(600 + k, 70 if k % 2 else 40, 10**6)
        rows += [(2 * k + i, f"{prose(2 * k + i, 60, 10**6)} {shared} {prose(50 + 2 * k + i, 60, 10**6)}") for i in (0, 1)]
    got = substring_dedup.repeated_passages(docs_of(spark, rows)).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in got} == {(d, d // 2 * 2) for d in (2, 3, 6, 7, 10, 11)}
    assert asked[0] >= 3 and not any(asked[1:])


def test_near_passages_share_a_seed():
    rng, hasher, run = random.Random(8), near_dedup.Hasher(5), substring_dedup.shared_run(46)
    for length in (50, 51, 60, 90, 140):
        for edit in ("insert", "delete", "replace"):
            for _ in range(30):
                p = [b"%d" % rng.randrange(10**6) for _ in range(length)]
                q = list(p)
                for _ in range(max(1, length // 45)):
                    k = rng.randrange(len(q))
                    q[k : k + (edit != "insert")] = [b"new%d" % rng.randrange(10**6)] * (edit != "delete")
                one, two = hasher.runs(p), hasher.runs(q)
                if len(np.intersect1d(one, two)) >= 0.8 * len(np.union1d(one, two)) and len(two) >= 46:
                    seeds = np.intersect1d(substring_dedup.seeds(one, run), substring_dedup.seeds(two, run))
                    parts = substring_dedup.segments(one, seeds, 46)
                    assert len(seeds) and sum(hi - lo for lo, hi in parts) >= 46


def test_a_staged_write_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f.rpartition("/")[2] for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = held()
    staged = stage(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.max("id").alias("m")), "shuffled")
    for _ in range(50):  # they go a little later
        if not held() - before:
            break
        time.sleep(0.2)
    assert not held() - before and staged.count() == 100


def test_passages_are_those_of_plain_sets():
    rng = np.random.default_rng(3)
    own = rng.integers(0, 300, 400).astype(np.uint64)
    other = np.where(rng.random(400) < 0.93, own, rng.integers(0, 300, 400)).astype(np.uint64)
    by = substring_dedup.Places(own, other)
    for lo, width, start, length in rng.integers((0, 46, 0, 46), (300, 100, 300, 100), (200, 4)).tolist():
        start = lo if start % 2 else start
        a, b = set(own[lo : lo + width].tolist()), set(other[start : start + length].tolist())
        want = len(a & b) / len(a | b)
        got = by.similarity(lo, lo + width, start, start + length)
        assert got == want or got == 0.0 and want < substring_dedup.SIMILAR
    for at in rng.integers(0, 400, 40).tolist():
        whole = by.aligned(0, 400, at, at + 3)
        part = by.aligned(max(0, at - 50), min(400, at + 50), at, at + 3)
        assert all(np.array_equal(w[max(0, at - 50) : at + 50], p) for w, p in zip(whole, part))


def test_repeated_passages_do_not_hang_on_the_order_of_rows(spark):
    passage = " ".join(f"w{i}" for i in range(70))
    one = " ".join([*(f"a{i}" for i in range(30)), passage, *(f"b{i}" for i in range(150)), passage, *(f"c{i}" for i in range(30))])
    rows = [(1, one)] + [(i, f"{prose(i, 40)} {passage} {prose(i + 50, 40)}") for i in range(2, 6)]
    docs = docs_of(spark, rows)
    some, others = (rows_of(substring_dedup.repeated_passages(d), *PASSAGE) for d in (docs.orderBy("doc_id").coalesce(1), docs.repartition(7, "text")))
    assert some == others and {r[0] for r in some} == {1, 2, 3, 4, 5}


def test_repeated_passages(spark):
    shared, short = prose(500, 60), prose(501, 40)
    rows = [(i, f"{prose(i, 90)} {shared} {prose(20 + i, 90)}") for i in range(6)] + [(10 + i, f"{prose(40 + i, 90)} {short} {prose(60 + i, 90)}") for i in range(6)]
    rows += [(30, edited(prose(700, 100), 1, 2)), (31, prose(700, 100)), (40, None), (41, ""), (42, "again " * 3000), (43, prose(800, 20000)), (None, shared)]
    got = substring_dedup.repeated_passages(odd_docs(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {0, 1, 2, 3, 4, 5, 30, 31}
    assert all(r["n_words"] >= 50 and r["similarity"] >= 0.8 for r in got)
    assert all(r["start_word"] == 90 and r["n_words"] == 60 for r in got if r["doc_id"] < 6)
    assert substring_dedup.repeated_passages(docs_of(spark, [])).count() == 0


def test_near_passages_are_found_by_windows_and_verified():
    rng = np.random.default_rng(3)
    odd = np.random.default_rng(5).integers(0, 1 << 63, substring_dedup.HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    hasher, some = near_dedup.Hasher(5), lambda n: [b"%d" % x for x in rng.integers(0, 10**6, n)]
    for length, edits in ((50, ("insert", "replace")), (60, ("insert", "delete", "replace"))):
        for edit in edits:
            found = 0
            for _ in range(100):
                p, k = some(length), length // 2
                q = p[:k] + ([] if edit == "delete" else some(1)) + p[k + (edit != "insert") :]
                one, two = hasher.runs(some(90) + p + some(90)), hasher.runs(some(50) + q + some(130))
                a, b = ({int(x[0]): x[1:] for x in zip(*substring_dedup.keyed_windows(s, 46, odd))} for s in (one, two))
                room = lambda key: min(a[key][1], b[key][1]) + min(a[key][2], b[key][2]) + 1 >= 0.8 * 46
                found += any(key in b and room(key) and substring_dedup.passage(one, two, int(a[key][0]), int(b[key][0]), 46) for key in a)
            assert found >= 95, (length, edit, found)


def test_sliding_centres_are_first_minima():
    values = np.random.default_rng(4).integers(0, 40, (2, 300)).astype(np.uint64) << np.uint64(30)
    for row, got in zip(values, substring_dedup.sliding_centres(values, 10)):
        assert [i + int(row[i : i + 10].argmin()) for i in range(291)] == got.tolist()


def test_a_passage_that_the_first_document_lacks_is_found(spark):
    p = prose(900, 70, 10**6).split()
    far = prose(901, 60, 10**6).split() + p[20:45] + prose(902, 60, 10**6).split()  # shares only a fragment
    q = p[:35] + ["new"] + p[35:]
    rows = [(1, " ".join(far))] + [(i, f"{prose(i, 80, 10**6)} {' '.join(x)} {prose(50 + i, 80, 10**6)}") for i, x in ((2, p), (3, q))]
    got = substring_dedup.repeated_passages(docs_of(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {2, 3}


def test_passages_end_where_a_shared_block_lies_elsewhere():
    p, block = prose(1, 70, 10**6).split(), prose(2, 60, 10**6).split()
    for k, edit in enumerate((["new"], [], [p[35], "new"])):  # word 35 replaced, deleted, followed by a new one
        q = p[:35] + edit + p[36:]
        one = prose(3, 90, 10**6).split() + p + block + prose(4, 90, 10**6).split()
        two = prose(5, 50, 10**6).split() + q + prose(6, 300, 10**6).split() + block
        own, other = (near_dedup.Hasher(5).runs([w.encode() for w in t]) for t in (one, two))
        for a, b, at, there in ((own, other, 100, 60), (other, own, 60, 100)):
            got = substring_dedup.passage(a, b, at, there, 46)
            assert got and (got[0], got[2]) == (at - 10, there - 10) and got[4] >= 0.8 and abs(got[1] - 66) <= 1


def test_compact_windows_partition_all_wide_subsequences():
    values = np.random.default_rng(1).permutation(60)
    cover = collections.Counter()
    for lo, c, hi in substring_dedup.compact_windows(values, 10):
        assert values[c] == values[lo : hi + 1].min()
        cover.update((i, j) for i in range(lo, c + 1) for j in range(c, hi + 1) if j - i + 1 >= 10)
    assert cover == collections.Counter((i, j) for i in range(60) for j in range(i + 9, 60))


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 1, (8, 16))
    vecs = [(i, (base[i % 8] + rng.normal(0, 0.12, 16)).tolist()) for i in range(400)]
    vecs += [(500 + i, base[0].tolist()) for i in range(5)] + [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] * 16), (605, (base[1] * 1e200).tolist()), (None, base[2].tolist()), (606, [1.0, 2.0]), (607, [2.0, 4.0])]
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in vecs], "vec_id long, embedding array<double>, label int, `same` int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(frame, tables=40, bits=4).collect()}
    good = [(i, np.array(v) / np.linalg.norm(np.array(v) / np.abs(v).max()) / np.abs(v).max()) for i, v in vecs if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(a, b) for k, (a, x) in enumerate(good) for b, y in good[:k] if len(x) == len(y) and x @ y >= 0.9]
    count, want = collections.Counter(n for p in links for n in p), classes({i for i, _ in vecs if i is not None}, links)
    for i, r in got.items():
        if i is not None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (count[i], want[i], want[i] == i)
    assert got[None]["n_links"] == 0 and got[None]["kept"]
    assert embedding_dedup.near_vectors(frame.where("false")).count() == 0
