"""Importance resampling, source divergences and secret scans on small tables, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from crowdspark.llm import divergence, importance, secret_scan
from tests.llm.test_operators import prose

#: A documents table whose other columns have the names that the operators use inside.
CLASHING = ("doc_id long, text string, lang string, source string, row long, score string, rank string, term string, owner string, "
            "kind string, start long, salt string, part string, item string, value string, n_words long, position long, above long")


def table(spark, rows):
    """Rows of (doc_id, text, lang, source) with clashing columns beside them."""
    return spark.createDataFrame([(*r, *[None] * 14) for r in rows], CLASHING)


# ---- 11: importance resampling ----

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain_features(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain_draw(rows, target, n=1):
    """{(doc_id, n_features, weight, score, rank)} of a draw of a tenth."""
    docs = [(i, *plain_features(t, n)) for i, t, *_ in rows]
    s, t = Counter(), Counter()
    for _, _, f in docs:
        s.update(f)
    for text in target:
        t.update(plain_features(text, n)[1])
    big, small = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for i, w, f in docs:
        gains = [math.floor(1000 * math.log((t[b] + 1) * big / ((s[b] + 1) * small))) for b in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((-r[4], r[0]) for r in out if r[1] >= 20 and r[0] is not None)
    return out, [i for _, i in able[: 10 * sum(r[1] >= 20 for r in out) // 100]]


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_matches_a_plain_draw(spark, n):
    rows = [(i, prose(i, 15 + i % 40), "en", "a") for i in range(150)]
    rows += [(200, None, None, None), (201, "", "", ""), (202, "Ünï " * 25 + "\x85 \xa0x", "de", "b"), (203, "w" * 5000 + " " + "w" * 300, "en", "a"),
             (204, "A1-b2_C3\n\x01 5\n" * 30, "en", "a"), (205, prose(7, 60000), "en", "a")]
    target = [prose(500, 60), None, "", "ünï"]
    got = importance.resample(table(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), max_words=n).collect()
    want, drawn = plain_draw(rows, target, n)
    assert sorted((r.doc_id, r.n_features, r.weight, r.score) for r in got) == sorted((r[0], *r[2:]) for r in want)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn and len(drawn) >= 10
    assert got[0].__fields__ == ["doc_id", "n_features", "weight", "score", "rank"]


def test_resampling_repeats_and_empty_tables(spark):
    rows = [(5, prose(1, 40), "en", "a")] * 30 + [(None, prose(2, 30), "en", "a")] * 3
    target = spark.createDataFrame([(prose(1, 40),)], "text string")
    got = importance.resample(table(spark, rows), target).collect()
    assert len(got) == 33 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3]
    assert len({(r.weight, r.score) for r in got if r.doc_id == 5}) == 1
    assert importance.resample(table(spark, rows).limit(0), target).count() == 0
    assert {r.weight for r in importance.resample(table(spark, rows[:1]), target.limit(0)).collect()} == {
        r[3] for r in plain_draw(rows[:1], [])[0]}


def test_crc_composition():
    rng = random.Random(3)
    pairs = [(rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.randint(0, 3000))) for _ in range(50)]
    got = importance.compose(*(np.array(x) for x in (
        np.array([zlib.crc32(a) for a, _ in pairs], np.uint32), np.array([zlib.crc32(b) for _, b in pairs], np.uint32),
        [len(b) for _, b in pairs])))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


# ---- 12: source divergence ----

def plain_audit(rows, min_documents, top):
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= min_documents]
        sources = [s for g, s in groups if g == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            out |= {(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)}
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms, 1)}
    return out


def audit_rows():
    rows = [(i, prose(i % 37, 50) + " Ünï-Ab ab2c", ("en", "de", None)[i % 3], f"s{i % 5}") for i in range(150)]
    return rows + [(900, None, "en", None), (901, "", None, "s9"), (902, "x y", "fr", "one"), (903, "1 2 3", "it", "a"),
                   (904, None, "it", "b"), (905, prose(1, 50), "en", "s1"), (905, prose(1, 50), "en", "s1"),
                   (906, "q" * 50000 + " " + prose(2, 3000), "en", "s2")]


def test_audit_matches_a_plain_count(spark):
    rows = audit_rows()
    got = {tuple(r) for r in divergence.audit_sources(table(spark, rows).repartition(5), 4, 6).collect()}
    assert got == plain_audit(rows, 4, 6)
    assert divergence.audit_sources(table(spark, rows).limit(0)).count() == 0


def test_audit_spills_and_blocks(spark, monkeypatch):
    """Stripes that are spilt at every step, and pairs in blocks of one source, give the same result."""
    rows = audit_rows()
    stripes = divergence.Stripes()
    monkeypatch.setattr(divergence, "SPILL_COUNTS", 40)
    monkeypatch.setattr(divergence, "STEP", 100)
    spilt = [b for _, text, lang, source in rows for b in stripes.fold(lang or "", source or "", (text or "").encode())]
    spilt += list(stripes.spill())
    assert len(spilt) > 300
    monkeypatch.setattr(divergence, "CELLS", 8)
    merged = divergence.merged_stripes(spark.createDataFrame([r for b in spilt for r in b.to_pylist()], divergence.STRIPES), 4)
    totals = defaultdict(dict)
    for r in merged.collect():
        for s, n in zip(r.sources, r.counts):
            totals[r.lang][s] = totals[r.lang].get(s, 0) + n
    kept = Counter(r.lang for r in merged.collect() if r.term)
    totals = {g: (kept[g], sorted(n), np.array([n[s] for s in sorted(n)])) for g, n in totals.items()}
    pairs = Counter()
    for r in divergence.divergences(merged, totals).where("part = 'pair'").collect():
        pairs[r.lang, r.source, r.item] += r.value
    assert pairs == Counter({(g, s, o): v for g, s, part, o, v, _ in plain_audit(rows, 4, 6) if part == "pair"})


def test_shares_do_not_overflow():
    counts, total, kept = np.array([0, 5 * 10**14, 10**15 - 7]), np.array([10**15]), 10**6
    assert divergence.share(counts, total, kept).tolist() == [
        1 + 10**9 * (int(c) + 5) // (10**15 + 5 * kept) for c in counts]


# ---- 13: secret scans ----

ASSIGN = re.compile("(?a)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)


def plain_base(text):
    """Base spans as (start, kind, end)."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_match_python(spark):
    rng = random.Random(5)
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", "PASSWORD", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH0123", "A", "0", "deadbeef",
            "0123456789abcdef", "g", "é", "😀", "\n", "x.y/z+", "=="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["secret=token: abcdefgh", "token=ab token=abcdef", "AKIA" * 6, "token ſecret=abcdefgh", "", None,
              "password = hunter22 " * 20000]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(table(spark, [(i, t, "en", None) for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        base = plain_base(text or "")
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert got[i].base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("owned")] == [s for s in listed(base).split(",") if s]


def test_owned_and_copied_values(spark):
    own, copied, bare = "Zx81kLmQp0aB77tYw3Rd9e", "Qw34rTyUiOp99aSdFgHjK2", "aa77bb-cc88dd-ee99ff-zz"
    rows = [(1, f"token = {own}", "en", "a"), (2, f"see {own} there", "de", "a"), (3, f"bare {own}", "en", "b")]
    rows += [(10 + i, f"key is {copied}", "en", f"s{i}") for i in range(4)]
    rows += [(20, f"id {bare}", "en", "a"), (30, f"id {bare}x", "en", "a"), (31, f"secret: {bare}x", "en", "b")]
    rows += [(40, "supercalifragilisticexpialidocious " + "A1b" * 100, "en", "a"), (41, "EXAMPLE1234567890abcDEFGHI", "en", "a"), (None, f"token={own}", None, None)]
    rows += [(50, f"api_key={copied}", None, "t")] * 3
    got = defaultdict(list)
    for r in secret_scan.scan_secrets(table(spark, rows), example_owners=4).collect():
        got[r.doc_id].append((r.spans, r.n_live, r.n_example))
    assert got[1] == [("assign:0:30", 1, 0)] and got[2] == [("owned:4:26", 1, 0)] and got[3] == [("owned:5:27", 1, 0)]
    assert got[None] == [("assign:0:28", 1, 0)]
    assert all(got[10 + i] == [("", 0, 0)] for i in range(4)) and got[50] == [("assign:0:30", 0, 1)] * 3
    assert got[20] == [("", 0, 0)] and got[30] == [("owned:3:27", 1, 0)] and got[31] == [("assign:0:32", 1, 0)]
    assert got[40] == [("", 0, 0)] and got[41] == [("", 0, 0)]
    assert secret_scan.scan_secrets(table(spark, rows).limit(0)).count() == 0
