"""The training-data operators on small tables: nulls, empty and long texts, ties, repeats, clashing names, brute force."""

import html as html_module
import io
import random
import re
import zipfile

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from crowdspark.llm import (archive, decontaminate, extract, license_scan, line_dedup, ngram_join, packing, quality, topk,
                            url_rules)
from crowdspark.llm.common import components, shingle_set, words
from crowdspark.llm.queries import ORACLES, QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows of (doc_id, text) as a documents table with nulls elsewhere."""
    return spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in rows], DOCS)


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("ka", "lo", "mi", "ne", "ru", "ta")) for _ in range(rng.randint(2, 4))) + "." * (i % 9 == 8)
                    for i in range(n))


# ---- shared helpers ----

def test_words_match_a_plain_split():
    texts = ["  ab  Ü c\n", None, "", "x" * 3000 + " y", "a\x0bb\x0cc\x1cd", "tab\tend"]
    hashes, starts, ends, bounds = words(pa.array(texts), lower=True)
    seen = {}
    for text, a, b in zip(texts, bounds, bounds[1:]):
        found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert len(found) == b - a
        for word, h in zip(found, hashes[a:b]):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components_match_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randint(-200, 200), rng.randint(-200, 200)) for _ in range(170)] + [(999, 1000 + i) for i in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- queries against their SQL ----

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    query = QUERIES[name](spark, SMALL)
    cursor = check.connect(SMALL).execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert check.rows_of(query.columns, [tuple(r) for r in query.collect()]) == check.rows_of(columns, cursor.fetchall())


# ---- 1: URL filters ----

def test_url_rules_and_edges(spark):
    rules = spark.createDataFrame([("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
                                   ("sub.example.org/en/1", "allow"), (None, "block"), ("", "block")], "rule string, verdict string")
    urls = spark.createDataFrame([
        (1, "http://A.Example.ORG/es/x?q#f", "h"), (2, "http://example.org/en/123", "h"), (3, "http://myexample.org/es/", "h"),
        (4, "http://example.org", "h"), (5, None, "h"), (6, "no scheme", "h"), (7, "http://sub.example.org/en/19", "h"),
        (7, "http://sub.example.org/en/19", "h"), (8, "http://example.net/es/", "h"), (9, "x://y://example.org/es/", "h"),
    ], "page_id long, url string, host string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(urls, rules).collect())
    assert got == sorted([
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "example.org", "/en/123", "example.org/en/1", "block"),
        (3, "myexample.org", "/es/", "org/", "allow"), (4, "example.org", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "", "", None, "allow"), (7, "sub.example.org", "/en/19", "sub.example.org/en/1", "allow"),
        (7, "sub.example.org", "/en/19", "sub.example.org/en/1", "allow"), (8, "example.net", "/es/", None, "allow"),
        (9, "y:", "//example.org/es/", None, "allow")])
    assert url_rules.judge_urls(urls.limit(0), rules).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(urls, rules.limit(0), default="block").collect()} == {"block"}


# ---- 2: quality classifier ----

def test_quality_holds_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality.classify(spark.read.parquet(f"{sf}/documents.parquet")).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.keep for r in judged if r.quality == 1]
    bad = [r.keep for r in judged if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_quality_edges(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, " \n"), (None, prose(1)), (4, prose(2)), (4, prose(2)), (5, "WORD!! " * 80),
                             (6, prose(3, 30000))])
    got = {(r.doc_id, r.keep) for r in quality.classify(docs).collect()}
    assert {(1, False), (2, False), (3, False)} <= got and quality.classify(docs).count() == 8
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.where("text is null").count() == 0
    assert quality.classify(docs.limit(0)).count() == 0


def test_em_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.75, 0.85, 0.9])
    vote = np.where((rng.random((20000, 8)) < right) == truth[:, None], quality.GOOD, quality.BAD)
    patterns, counts = np.unique(quality.codes(vote), return_counts=True)
    _, accuracies, share = quality.expectation_maximisation(dict(zip(patterns.tolist(), counts.tolist())))
    assert abs(share - 0.7) < 0.02 and np.abs(accuracies[:, 1, quality.GOOD] - right).max() < 0.03


# ---- 3: top-k ----

def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(120)]  # ties
    vectors += [(2000, None), (2020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2040, [float("nan")] * 6), (None, vectors[0][1]), (2060, []),
                (2080, [1.0, 2.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(
        table, F.col("id") % 20 == 0, k=7, scale=64.0, shard_rows=50).collect()}
    whole = {i: np.floor(64 * np.array(v)) for i, v in vectors if i is not None and v and None not in v and len(v) == 6 and v[0] == v[0]}
    want = {}
    for q in whole:
        if q % 20 == 0:
            scores = sorted(((-int(whole[q] @ x), i) for i, x in whole.items() if i != q))[:7]
            want |= {(q, n): (i, -s) for n, (s, i) in enumerate(scores, 1)}
    assert got == want
    assert topk.top_k(table.limit(0), F.col("id") % 20 == 0).count() == 0


# ---- 4: packing ----

def test_packing_is_an_exact_round_trip(spark):
    import zlib

    from tokenizers import Tokenizer
    rows = [(i, prose(i, 40 + 37 * i)) for i in range(30)] + [(100, None), (101, ""), (102, prose(9, 6000)), (None, "null id"),
                                                              (3, prose(3, 151)), (103, "It's 3×² <|endoftext|> Ça!\x1cb ΑΣ")]
    docs = documents(spark, rows).coalesce(1)
    pieces = packing.pack_documents(docs, tokenizer_path, shard_docs=10).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    sequences, seen = {}, {}
    for p in pieces:
        options = [x for x in ids[p.doc_id] if len(x) == p.doc_tokens]
        assert any(zlib.crc32(np.array(x[p.start: p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for x in options)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        seen.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    for (doc_id, total), parts in seen.items():
        covered = np.zeros(total, int)
        for start, length in parts:
            covered[start: start + length] += 1
        assert (covered == len([x for x in ids[doc_id] if len(x) == total])).all()
    assert sum(p.length for p in pieces) == sum(len(x) for xs in ids.values() for x in xs)
    assert packing.pack_documents(docs.limit(0), tokenizer_path).count() == 0


def test_bm25_neighbours_share_words():
    docs = [np.array([1, 2, 3, 4]), np.array([9, 8, 7]), np.array([3, 4, 5]), np.array([7, 7, 9])]
    index = packing.Bm25Index(docs)
    assert index.neighbours(0, np.array([False, True, True, True])).tolist() == [2]
    assert index.neighbours(1, np.array([True, False, True, True])).tolist() == [3]


def test_bm25_neighbours_match_plain_scores():
    rng = random.Random(4)
    docs = [np.array([rng.randint(1, 60) for _ in range(rng.randint(1, 40))]) for _ in range(60)]
    index = packing.Bm25Index(docs)
    mean = sum(map(len, docs)) / len(docs)
    frequency = {t: sum(t in d for d in docs) for t in range(1, 61)}
    idf = {t: np.log1p((len(docs) - n + 0.5) / (n + 0.5)) for t, n in frequency.items()}

    def score(terms, doc):
        total = 0.0
        for t in terms:
            n = int((doc == t).sum())
            norm = packing.K1 * (1 - packing.B + packing.B * len(doc) / mean)
            total += idf[t] * n * (packing.K1 + 1) / (n + norm)
        return total

    for seed, doc in enumerate(docs):
        terms = {t: int((doc == t).sum()) for t in sorted(set(doc.tolist())) if frequency[t] > 1}
        asked = sorted(terms, key=lambda t: -idf[t] * min(terms[t], 4))[:packing.QUERY_TERMS]
        unused = np.array([rng.random() < 0.7 and d != seed for d in range(len(docs))])
        want = {d: score(asked, docs[d]) for d in np.flatnonzero(unused) if set(asked) & set(docs[d].tolist())}
        got = index.neighbours(seed, unused).tolist()
        assert sorted(got) == sorted(want)
        assert np.allclose([want[d] for d in got], sorted(want.values(), reverse=True))


def test_packing_ignores_clashing_columns(spark):
    docs = documents(spark, [(i, prose(i, 50 + i)) for i in range(8)]).coalesce(1)
    more = docs.withColumns({name: F.lit("x") for name in packing.PIECE_NAMES if name != "doc_id"})
    plain, clashing = (sorted(map(tuple, packing.pack_documents(d, tokenizer_path).collect())) for d in (docs, more))
    assert plain == clashing and len(plain) >= 8


def test_a_worker_keeps_one_vocabulary():
    first = packing.word_pieces(tokenizer_path(), 1)
    assert packing.word_pieces(tokenizer_path(), 1) is first
    ids = first.encode("kept words kept")
    assert first.encode("kept words kept") == ids and ids.endswith(np.uint32(1).tobytes())
    assert packing.word_pieces(tokenizer_path(), 2).encode("kept").endswith(np.uint32(2).tobytes())


# ---- 5: archives ----

def test_archives_round_trip(spark):
    big = "ü" * 600  # 1200 bytes
    pages = spark.createDataFrame([(1, "u1", big, "x"), (2, None, big, "x"), (3, "u3", "", "x"), (4, "u4", None, "x"), (None, "u", big, "x"),
                                   (5, "u5", "a\r\n\r\nb" * 300, "x"), (6, "u6", "short", "x"), (7, "u7", "short", "x")],
                                  "page_id long, url string, html string, payload string")
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archive.archive_round_trip(pages).collect()}
    assert got == {(1, 1200, "revisit", 2), (2, 1200, "response", None), (None, 1200, "revisit", 2), (3, 0, "response", None),
                   (4, 0, "response", None), (5, 1800, "response", None), (6, 5, "response", None), (7, 5, "response", None)}
    assert archive.archive_round_trip(pages.limit(0)).count() == 0


def test_archive_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>\r\n\r\n") for i in range(50)], "page_id long, url string, html string")
    made = archive.write_archives(archive.plan_records(pages), f"file:{tmp_path}/warc", archive_bytes=1500)
    assert made.count() > 2
    back = {r.page_id: (r.url, bytes(r.payload).decode()) for r in archive.read_archives(spark, made).collect()}
    assert back == {i: (f"http://x/{i}", f"<p>{i}</p>\r\n\r\n") for i in range(50)}


def test_zip64_directories_and_broken_files():
    def zipped(**kw):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", kw.get("method", zipfile.ZIP_STORED)) as z:
            with z.open("a/b.warc", "w", force_zip64=True) as member:
                member.write(b"hello")
            z.writestr("indexes/i", b"x" * 10)
        return out.getvalue()

    plain = zipped()
    found = archive.members(io.BytesIO(plain), len(plain))
    assert {n: plain[o: o + s] for n, (o, s) in found.items()} == {"a/b.warc": b"hello", "indexes/i": b"x" * 10}
    limit, zipfile.ZIP64_LIMIT = zipfile.ZIP64_LIMIT, 3  # makes every size and offset a 64-bit one
    try:
        wide = zipped()
    finally:
        zipfile.ZIP64_LIMIT = limit
    assert archive.END64 in wide
    found = archive.members(io.BytesIO(wide), len(wide))
    assert {n: wide[o: o + s] for n, (o, s) in found.items()} == {"a/b.warc": b"hello", "indexes/i": b"x" * 10}
    for bad in (b"", b"nothing", plain[:-30], zipped(method=zipfile.ZIP_DEFLATED)):
        with pytest.raises(ValueError):
            archive.members(io.BytesIO(bad), len(bad))


# ---- 6: line dedup ----

def test_line_dedup_edges(spark):
    lines = [prose(i, 8) for i in range(40)]
    long = prose(77, 60)
    docs = documents(spark, [
        (1, "\n".join(lines)), (2, "\n".join(["own first", *lines, "own last"])), (3, None), (4, ""), (5, "one\n\n\n"),
        (6, f"a\n{long}\nb"), (7, f"c\n{long}"), (8, "\n".join(lines)), (8, "\n".join(lines)), (None, "x\ny"), (9, "single line")])
    docs = docs.withColumn("chunks", F.lit("clash"))
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == 11 and "chunks" not in rows[0].asDict()
    text = {r.doc_id: r.text for r in rows}
    assert text[1] == "\n".join(lines) and text[3] is None and text[4] == "" and text[5] == "one\n\n\n"
    assert text[6] == f"a\n{long}\nb" and text[7] == "c"
    assert text[8] == text[8] and len(text[8].split("\n")) < 12  # single lines between boundaries stay
    assert text[2].startswith("own first") and "own last" in text[2] and len(text[2]) < len(text[1]) / 2
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_repeated_passages_of_short_lines_go_whole(spark):
    rows, parts, seed = [], [], 5000
    for copy, (n, size) in enumerate([(5, 12), (3, 20), (8, 10), (12, 10), (2, 6)] * 4):
        parts.append("\n".join(prose(seed + i, size) for i in range(n)))
        for side in range(2):
            before, after = ([prose(seed + 100 + side * 20 + x * 10 + i, 11) for i in range(4)] for x in range(2))
            rows.append((100 * side + copy, "\n".join([*before, parts[-1], *after])))
        seed += 200
    lone, long = prose(1, 20), prose(2, 50)
    rows += [(300, f"{lone}\n{prose(3, 9)}"), (301, f"{prose(4, 9)}\n{lone}"), (302, f"a\n{long}"), (303, f"b\n{long}"),
             (304, "c\nc\nc\nc"), (305, "d\n\ne\nf"), (306, "g\nd\n\ne"), (307, None), (308, ""), (309, "h\n\n"), (309, "h\n\n"),
             (310, parts[0]), (None, "i\nj")]
    rows = line_dedup.dedup_passages(documents(spark, rows).withColumn("gone", F.lit("clash"))).collect()
    assert len(rows) == 53 and "gone" not in rows[0].asDict()
    text, removed = {r.doc_id: r.text for r in rows}, {r.doc_id: r.removed_lines for r in rows}
    for copy, part in enumerate(parts):
        assert part in text[copy] and removed[copy] == 0
        assert not set(part.split("\n")) & set(text[100 + copy].split("\n")) and text[100 + copy].count("\n") == 7
    assert lone in text[300] and lone in text[301] and long in text[302] and text[303] == "b"  # single short lines stay
    assert text[304] == "c" and text[305] == "d\n\ne\nf" and text[306] == "g" and text[307] is None and text[308] == ""
    assert text[309] == "h\n\n" and text[310] == "" and removed[310] == 5 and text[None] == "i\nj"
    assert line_dedup.dedup_passages(documents(spark, rows[:0])).count() == 0


def test_repeated_passages_go_by_chunks_first(spark):
    """The rolling hash finds chunks inside a passage, whatever stands around it; the pairs of lines find its edges."""
    passage = [prose(7000 + i, 9) for i in range(30)]
    rows = [(n, "\n".join([*(prose(7100 + 50 * n + i, 8) for i in range(3 + n)), *passage, "", prose(7300 + n, 8)])) for n in (1, 2)]
    docs = documents(spark, rows)
    keys = {r.doc_key: r.doc_id for r in docs.select("doc_id", line_dedup.doc_key().alias("doc_key")).collect()}
    found = line_dedup.chunk_passages(docs).collect()
    gone = {i for r in found for i in range(r.first, r.last + 1)}
    assert {keys[r.doc_key] for r in found} == {2} and gone < set(range(5, 35)) and len(gone) > 10
    kept = {r.doc_id: (r.text, r.removed_lines) for r in line_dedup.dedup_passages(docs).collect()}
    lines = rows[1][1].split("\n")
    assert kept == {1: (rows[0][1], 0), 2: ("\n".join(lines[:5] + lines[35:]), 30)}


# ---- 7: n-gram join ----

def brute_near_duplicates(rows, n, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, root = [], list(range(len(rows)))
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def near_rows():
    rng = random.Random(8)
    base = prose(5, 90).split()
    rows = [(i, prose(100 + i, rng.randint(1, 80))) for i in range(40)]
    for i in range(120):  # near copies around the threshold, chains among them
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(60)}"
        rows.append((200 + i, " ".join(copy)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "One  TWO"), (505, "two one"), (506, prose(100, 50)),
             (506, prose(100, 50)), (507, prose(3, 20000)), (508, prose(3, 20000) + " end")]
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    for n, percent in ((4, 85), (5, 80)):
        got = sorted(tuple(r) for r in ngram_join.near_duplicates(documents(spark, rows), n, percent).collect())
        assert got == brute_near_duplicates(rows, n, percent)
    assert ngram_join.near_duplicates(documents(spark, [])).count() == 0
    kept = ngram_join.keep_one(documents(spark, [(1, "a b c d e"), (2, "A b c d e"), (3, None), (4, ""), (None, "z")]))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4]


def test_one_row_of_repeated_ids_stays(spark):
    text, other = prose(41, 60), prose(42, 60)
    rows = [(7, text)] * 50 + [(8, text)] * 3 + [(9, text), (9, other), (9, other), (5, prose(43, 60)), (5, text + " end"),
                                                 (None, text), (None, text), (6, ""), (6, ""), (4, None), (4, None)]
    docs = documents(spark, rows).withColumn("_kept", F.lit(2)).repartition(5)
    kept = ngram_join.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept.collect())) == sorted(
        [(5, prose(43, 60)), (5, text + " end"), (9, other), (0, text), (0, text), (6, ""), (6, ""), (4, ""), (4, "")])


def test_filters_never_exclude_a_link():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, cut = int(rng.integers(1, 300)), rng.integers(0, 30)
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[min(cut, len(x)):], rng.integers(0, 1 << 63, int(rng.integers(0, 20)), dtype=np.uint64)]))
        if not len(y):
            continue
        common, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if 100 * common >= 85 * union:
            order = lambda s: s[np.argsort(s % np.uint64(7), kind="stable")][: ngram_join.prefix_length(len(s), 85)]
            assert len(np.intersect1d(order(x), order(y)))
            assert len(x) + len(y) - 2 * -(-85 * (len(x) + len(y)) // 185) >= union - common


def test_short_sequences_are_one_shingle():
    hashes, _, _, bounds = words(pa.array(["a", "a a", "a a a", "a a a a", "b a", "a b"]))
    made = [shingle_set(hashes[a:b], 4) for a, b in zip(bounds, bounds[1:])]
    assert all(len(s) == 1 for s in made) and len({int(s[0]) for s in made}) == 6


# ---- 8: HTML extraction ----

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body><header>Head</header>
<nav><ul><li><a href=x>Menu</a><li><a href=y>More</a></ul></nav><article><h1>Ti&amp;tle</h1><p>First   long paragraph of text,
with &lt;signs&gt; &eacute;.<p title="a>b">To.</p><!-- <p>gone</p> --><div class="ad">Buy now, it is cheap today.</div>
<form>Name <input name=a> here</form><p><b>Bold<br>line</b> ends.</p><section id="comments"><p>Nice article, I like it very much.</p>
</section></article><aside>Side bar text</aside><footer>&copy; us</footer>"""


def test_extraction_keeps_the_article(spark):
    assert extract.main_text(PAGE, extract.START) == "Ti&tle\nFirst long paragraph of text, with <signs> é.\nTo.\nBold line ends."
    pages = spark.createDataFrame([(1, "u", PAGE, 3), (2, None, None, 3), (3, "u", "", 3), (None, "u", "<p>", 3),
                                   (4, "u", "<article><p>" + "Word one. " * 30000, 3), (1, "u", PAGE, 3), (5, "u", "a < b", 3)],
                                  "page_id long, url string, html string, text int")
    rows = extract.extract_pages(pages).collect()
    assert len(rows) == 7 and all(r.n_chars == len(r.text) for r in rows)
    text = {r.page_id: r.text for r in rows}
    assert text[1].startswith("Ti&tle\nFirst") and text[2] == text[3] == text[None] == "" and len(text[4]) == 299999
    assert extract.extract_pages(pages.limit(0)).count() == 0


def test_wrappers_and_embedded_text_leave_the_article():
    body = "<p>First long paragraph of the text, which ends here.</p><p>Second long paragraph of the text, it ends too.</p>"
    text = "First long paragraph of the text, which ends here.\nSecond long paragraph of the text, it ends too."
    for open_, close in (("<div class='has-sidebar'>", "</div>"), ("<div class=page-header-fixed>", "</div>"), ("<form>", "</form>"),
                         ("<div id='search-results'>", "</div>"), ("<div><svg><g>", "</div>")):
        for name in ("article", "main"):
            assert extract.main_text(f"<body>{open_}<{name}>{body}</{name}>{close}</body>", extract.START) == text, open_
    for open_, close in (("<nav>", "</nav>"), ("<aside>", "</aside>"), ("<div class='comment-list'>", "</div>"),
                         ("<div class=sidebar>", "</div>"), ("<div hidden>", "</div>")):
        assert extract.main_text(f"<body>{open_}<article>{body}</article>{close}</body>", extract.START) == "", open_
    page = ("<article><p>Let the value <math><mi>x</mi></math> be given in <svg><text>this drawing</text></svg> and so on.</p>"
            "<noscript><p>This figure is shown to readers as a long text.</p></noscript><p>After an <object>open one it goes on.</p>"
            "<p>The last long paragraph of the article ends here.</p></article>")
    assert extract.main_text(page, extract.START) == (
        "Let the value x be given in this drawing and so on.\nThis figure is shown to readers as a long text.\n"
        "After an open one it goes on.\nThe last long paragraph of the article ends here.")
    assert extract.main_text("<noscript>Please turn on scripts to read this page.</noscript>", extract.START) == ""


def test_min_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(1, 7)
        content, boiler = [rng.random() * 3 for _ in range(n)], [rng.random() * 3 for _ in range(n)]
        edges = [(a, b, rng.random()) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(keep):
            return sum(boiler[i] if keep[i] else content[i] for i in range(n)) + sum(c for a, b, c in edges if keep[a] != keep[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(extract.min_cut(content, boiler, edges)) - best) < 1e-9


def test_extraction_matches_a_plain_reading_of_the_pages():
    for _, page in duckdb.sql(f"select page_id, html from '{SMALL}/pages.parquet'").fetchall():
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [" ".join(html_module.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:h1|p)>", body)]
        assert extract.main_text(page, extract.START) == "\n".join(p for p in parts if p)


# ---- 9: licenses ----

def test_license_spans(spark):
    mit = license_scan.TEMPLATES["MIT"]
    changed = mit.replace("free of charge, ", "").replace("modify, merge, publish,", "modify, publish and")
    rows = [(1, "Some text.\nLicensed under CC BY-NC 4.0.\nMore."), (2, f"// {changed.upper()} // code"), (3, None), (4, ""),
            (5, "license of a boat"), (6, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."), (None, "All rights reserved."),
            (7, prose(1, 30000) + " Released under the MIT License. " + prose(2, 100))]
    got = license_scan.scan_licenses(documents(spark, rows)).collect()
    text = dict(rows)
    assert sorted((r.doc_id or 0, r.license) for r in got) == [
        (0, "all-rights-reserved"), (1, "CC-BY-NC-4.0"), (2, "MIT"), (6, "CC-BY-NC-4.0"), (6, "CC-BY-NC-4.0"), (7, "MIT-short")]
    for r in got:
        assert 0.8 <= r.coverage <= 1 and r.matched_words <= r.template_words
        if r.doc_id in (1, 6):
            assert text[r.doc_id][r.char_start: r.char_end] == "Licensed under CC BY-NC 4.0."
    assert license_scan.scan_licenses(documents(spark, [])).count() == 0


def test_license_scan_matches_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    got = {(r.doc_id, r.license) for r in QUERIES["op9_license_scan"](spark, SMALL).collect()}
    plain = lambda t: " ".join(license_scan.normal(w) for w in license_scan.WORD.findall(t))
    whole = {(d, n) for d, t in docs for n, x in license_scan.TEMPLATES.items() if f" {plain(x)} " in f" {plain(t or '')} "}
    assert whole <= got


# ---- 10: decontamination ----

def test_leaks_and_paraphrases(spark):
    items = [(i, prose(300 + i, 20 + i)) for i in range(30)]
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (None, "x y"), (3, items[3][1])], "item_id long, text string")
    w = items[5][1].split()
    near = " ".join(w[:4] + ["extra"] + w[5:12] + w[13:])  # a word more, two other words
    part = " ".join(items[8][1].split()[:9])
    rows = [(1, prose(1, 200)), (2, prose(2, 60) + " " + items[2][1].upper() + "\n" + prose(3, 70)), (3, near), (4, part + " " + prose(4, 90)),
            (5, None), (6, ""), (None, items[7][1]), (7, prose(5, 20000) + " " + items[9][1]), (7, prose(5, 20000) + " " + items[9][1])]
    docs = documents(spark, rows).withColumn("item_id", F.lit(1))
    got = sorted((r.doc_id or 0, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect())
    assert got == [(0, 7), (2, 2), (3, 5), (7, 9), (7, 9)]
    kept = decontaminate.keep_clean(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6] and kept.columns == docs.columns
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0


def test_leak_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    want = set(duckdb.sql(f"select doc_id, item_id from '{sf}/documents.parquet' d join '{sf}/benchmark.parquet' b "
                          "on contains(d.text, b.text)").fetchall())
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontamination"](spark, sf).collect()}
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 2


def test_every_leak_of_a_passage_is_found(spark):
    rng = random.Random(12)
    items = [(i, prose(700 + i, rng.randint(15, 59))) for i in range(150)]
    rows = []
    for i, text in items[:40]:
        w = text.split()
        mixed, part = list(w), [x for x in w if rng.random() < 0.86]
        rng.shuffle(mixed)  # nearer in latent space than what follows, but in no order
        rows.append((i, " ".join([*mixed, prose(900 + i, 120), *part, prose(950 + i, 70 + i)])))
        rows.append((100 + i, " ".join([prose(1000 + i, i), *(x for y in w for x in (y, "zu") if x == y or rng.random() < 0.3)])))
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    hashes, want = dict(zip([d for d, _ in rows], decontaminate.item_words([t for _, t in rows]))), set()
    for (i, text), item in zip(items, decontaminate.item_words([t for _, t in items])):
        steps, answer = 3, item[-decontaminate.answer_length(text):]
        while len(item) > (steps - 1) * 8 + 1:
            steps *= 2
        for d, w in hashes.items():
            for a in range(0, len(w), 8):
                part = w[max(0, a - 8): a + 8 * steps + 8]
                share = decontaminate.common_subsequence(item, part) / len(item)
                if share >= 0.8 or share >= 0.6 and decontaminate.common_subsequence(answer, part) >= 0.8 * len(answer):
                    want.add((d, i))
    assert len(want) > 60
    for rank in (96, 2):
        got = [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark, rank).collect()]
        assert len(got) == len(want) and set(got) == want


def test_blocks_of_items_go_one_after_the_other(spark, monkeypatch):
    items = [(i, prose(300 + i, 20 + i)) for i in range(30)]
    rows = [(1, prose(1, 200)), (2, items[2][1]), (2, items[2][1]), (None, prose(2, 9) + " " + items[7][1]), (3, None), (4, "")]
    docs, benchmark = documents(spark, rows).withColumn("row", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    made, known = [], decontaminate.LeakFinder.__init__

    def counted(self, *args):
        known(self, *args)
        made.append(len(self.ids))

    monkeypatch.setattr(decontaminate.LeakFinder, "__init__", counted)
    leaks = decontaminate.find_leaks(docs, benchmark, block_items=10)
    assert len(made) == 3 and sum(made) == 30  # blocks come by hash, so their sizes vary
    assert sorted((r.doc_id or 0, r.item_id) for r in leaks.collect()) == [(0, 7), (2, 2), (2, 2)]
    kept = decontaminate.keep_clean(docs, benchmark, block_items=10)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(0, 30)), rng.integers(0, 6, rng.integers(0, 40))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]


# ---- the pipeline ----

def test_pipeline_stages_in_turn(spark):
    rows = near_rows()[:60]
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    rows += [(900, "WORD!! " * 90), (901, prose(901, 90) + " " + item), (902, prose(902, 90))]
    docs = documents(spark, rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "stage")
        assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
        kept[name] = {r.doc_id for r in docs.collect()}
    assert 900 not in kept["quality classifier"] and {901, 902} <= kept["quality classifier"]
    before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert 901 in kept["n-gram Jaccard join"] and 901 not in kept["benchmark decontamination"] and 902 in kept["benchmark decontamination"]
    assert all(d == c for d, _, c in brute_near_duplicates(before, 5, 80))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in pieces.collect()} == kept["benchmark decontamination"]


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and out.columns == packing.PIECE_NAMES


def test_wide_sketches_bound_the_difference_of_sets():
    rng = np.random.default_rng(5)
    for n, m, common in [(400, 390, 380), (700, 520, 500), (5000, 4300, 100), (2100, 2040, 2000)]:
        some = rng.integers(1, 1 << 63, n + m - common, dtype=np.uint64)
        x, y = (np.frombuffer(ngram_join.wide_sketch(s), np.uint64) for s in (some[:n], some[n - common:]))
        assert ngram_join.wide_apart(x, y) == ngram_join.wide_apart(y, x) <= n + m - 2 * common
    assert ngram_join.wide_sketch(some[:320]) == b""


def test_each_row_of_a_repeated_query_has_its_own_results(spark):
    """Equal rows of a query id are separate queries, and other columns may have the names used inside."""
    vectors = [(0, [1.0, 0.5], 1, 2), (0, [1.0, 0.5], 1, 2), (0, [0.0, 1.0], 1, 2)]
    vectors += [(i, [i / 8, 1 - i / 8], 3, 4) for i in range(1, 31)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, id long, dim long")
    got = [tuple(r) for r in topk.top_k(table, F.col("id") == 0, k=20, shard_rows=8).collect()]
    want = []
    for key, query, *_ in vectors:
        if key == 0:
            scores = sorted((-sum(int(64 * a // 1) * int(64 * b // 1) for a, b in zip(query, x)), i) for i, x, *_ in vectors if i != 0)
            want += [(0, rank, i, -s) for rank, (s, i) in enumerate(scores[:20], 1)]
    assert sorted(got) == sorted(want)


def test_many_license_matches_in_one_text():
    """Matches kept are those of a plain comparison of all pairs, and their number costs no square of it."""
    index = license_scan.TemplateIndex({"a": "one two three four five", "b": "three four five six seven eight", "c": "nine ten one two"})
    rng = random.Random(3)
    for n in (1, 5, 60, 3000):
        words = [w for _ in range(n) for w in rng.choice(["one two three four five", "six seven eight", "nine ten", "x"]).split()]
        hits = [(t, p, 0) for t in range(3) for p in range(len(words)) if words[p] == index.words[t][0]]
        got = license_scan.scan_text(index, words, hits, 2, 0.8)
        assert got == sorted(got, key=lambda m: m[2]) and all(a[3] <= b[2] for a, b in zip(got, got[1:]))
        if n == 3000:
            assert len(got) > 500
