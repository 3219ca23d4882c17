"""Divergence, byte-level BPE and periodic runs against brute-force versions."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import bpe, divergence, periodic
from waymark.llm.queries import BPE_FILE, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"
BIG = 2 ** 53 + 1


# ------------------------------------------------------------------ divergence

def divergence_brute(rows, min_docs, top):
    seen, group = defaultdict(set), defaultdict(Counter)
    for i, (text, lang, source) in enumerate(rows):
        c = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        group[lang or "", source or ""] += c
        for t in c:
            seen[lang or "", t].add(i)
    out = set()
    for lang in {g for g, _ in group}:
        kept = sorted(t for (g, t), d in seen.items() if g == lang and len(d) >= min_docs)
        sources = {s: c for (g, s), c in group.items() if g == lang}
        whole = sum((Counter(c) for c in sources.values()), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in sources.items()}, shares(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(f(p[s][t], q[t]), t) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", more)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(items) if part == "pair" or k < top}
    return out


def test_divergence_is_brute_force(spark, rows):
    rng = random.Random(3)
    words = ["Alpha", "beta", "BETA", "gamma-delta", "Éé", "你好", "x1y", "zeta", "'s", "eta\x7ftheta"]
    data = [(BIG + i // 3, " ".join(rng.choices(words[:4 + i % 7], k=rng.randint(0, 30))), rng.choice(["en", "de", None, ""]),
             rng.choice(["a", "b", "ç", None, "only"])) for i in range(300)]
    data += [(None, None, "fr", "a"), (1, "", "fr", "b"), (1, "", "fr", "b"), (2, "rare", "fr", "a"), (3, "word " * 9000, "en", "a")]
    got = divergence.divergence(rows(data, DOCS), min_docs=10, top=3)
    assert {tuple(r) for r in got.collect()} == divergence_brute([d[1:] for d in data], 10, 3)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string",
                                "value": "bigint", "rank": "int"}


def test_divergence_hands_on_what_it_counted(spark, rows, monkeypatch):
    data = [(i, f"w{chr(97 + i % 26)} common x{chr(97 + i % 5)}", "en", "ab"[i % 2]) for i in range(200)]
    expected = divergence_brute([d[1:] for d in data], 2, 10)
    parts = list(divergence._emitted({("en", "a"): (Counter(map(str.encode, map(str, range(7)))), Counter())}))
    assert parts[0]["term"].to_pylist()[0] is None and sum(p.num_rows for p in parts) == 8
    monkeypatch.setattr(divergence, "ROWS", 3)
    parts = list(divergence._emitted({("en", "a"): (Counter(map(str.encode, map(str, range(7)))), Counter())}))
    assert [p.num_rows for p in parts] == [4, 3, 1]
    assert {tuple(r) for r in divergence.divergence(rows(data, DOCS), min_docs=2).collect()} == expected


def test_divergence_of_large_counts(spark):
    p = spark.sql("SELECT 600000000000L AS n, 900000000000L AS total").select(
        divergence._share(divergence.F.col("n"), divergence.F.col("total")).alias("p")).first().p
    assert p == 1 + 10 ** 9 * (600000000002) // 900000000000


def test_divergence_of_nothing(spark, rows):
    assert divergence.divergence(rows([], DOCS)).count() == 0
    got = divergence.divergence(rows([(1, None, None, None), (2, "few words", "", "b")], DOCS)).collect()
    assert {(r.source, r.item, r.value, r["rank"]) for r in got} == {("", "b", 0, 1), ("b", "", 0, 1)}


# ------------------------------------------------------------------ byte-level BPE

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizers.path(BPE_FILE), "rb") as f:
        return bpe.Vocabulary(f.read(), tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=vocabulary.rank, special_tokens={})


def _ids(v, text):
    return np.frombuffer(v.encode(text), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("abdeinorst ", max_size=120), st.text("=- \n\taA1é你", max_size=90)))
def test_bpe_is_the_library_and_the_merges(vocabulary, library, text):
    ids = _ids(vocabulary, text)
    assert ids == library.encode_ordinary(text)
    assert ids == [r for p in vocabulary.pieces.findall(text) for r in vocabulary.merged(p.encode())]
    assert vocabulary.decode(vocabulary.encode(text)) == text.encode()


def test_bpe_of_every_code_point(vocabulary, library):
    for c in [*range(0xD800), *range(0xE000, 0x110000, 37)]:
        text = f"a{chr(c)}{chr(c)}b 1{chr(c)} {chr(c)}!"
        assert _ids(vocabulary, text) == library.encode_ordinary(text), hex(c)


def test_bpe_of_joined_tokens_and_long_pieces(vocabulary, library):
    rng = random.Random(7)
    names = list(vocabulary.rank)
    for _ in range(500):
        text = b"".join(rng.choices(names, k=rng.randint(1, 30))).decode("utf-8", "ignore").replace(" ", "")
        assert _ids(vocabulary, text) == library.encode_ordinary(text)
    for text in ("ab" * 50_000, "=" * 30_001, "".join(rng.choices("abcdefghij", k=50_000))):
        assert _ids(vocabulary, text) == library.encode_ordinary(text)


def _small(names):
    import base64
    return bpe.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(names)), r"\w+")


def test_bpe_backtracks():
    """bc merges before ab and cd, so the merges never give abcd but a, bc, d."""
    v = _small([b"a", b"b", b"c", b"d", b"bc", b"ab", b"cd", b"abcd"])
    assert v.given[7] is False
    assert _ids(v, "abcd") == [7]                        # a whole piece is its token
    for text in ("abcdabcd", "abcda", "aabcd", "abab", "cdcd", "abcb"):
        assert _ids(v, text) == v.merged(text.encode())


def test_bpe_of_random_vocabularies():
    """Vocabularies grown by random merges: every pair of tokens and random pieces."""
    rng = random.Random(11)
    for _ in range(40):
        names = [b"a", b"b", b"c"]
        while len(names) < 25:
            t = rng.choice(names) + rng.choice(names)
            if t not in names and len(t) < 9:
                names.append(t)
        v = _small(names)
        given = [r for r in range(len(names)) if v.given[r]]
        assert given == [r for r in range(len(names)) if v.merged(names[r]) == [r]]
        for a in given:
            for b in given:
                assert v.compatible[a, b] == (v.merged(names[a] + names[b]) == [a, b]), (names, a, b)
        for _ in range(60):
            text = "".join(rng.choices("abc", k=rng.randint(1, 40)))
            if text.encode() not in names:
                assert _ids(v, text) == v.merged(text.encode()), (names, text)


def test_bpe_rows(spark, rows, library):
    data = [(BIG, "two words"), (None, "two words"), (BIG, None), (4, ""), (5, "<|endoftext|> " * 3000), (6, "a\x00b  é"), (BIG, "two words")]
    df = rows(data, "doc_id long, text string")
    path, pattern = tokenizers.path(BPE_FILE), tokenizers.PATTERN
    got = bpe.decode(bpe.encode(df, path, pattern), path, pattern)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.data)) for r in got.collect()) == Counter(
        (k, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in data)
    assert bpe.encode(df.limit(0), path, pattern).count() == 0


def test_bpe_small_memo(spark, vocabulary, library, monkeypatch):
    small = bpe._Filled(vocabulary._packed, 4, lambda p: len(p) < 3)
    asked = ["a", "b", "c", "abc", "a", "d", "e", "f", "a", "b"]
    assert [small[p] for p in asked] == [vocabulary._packed(p) for p in asked]
    assert len(small) <= 2 and len(small._old) <= 2 and "abc" not in small


def test_bpe_file_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_FILE", 10)
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), tokenizers.path(BPE_FILE), r"\w+")


def test_op12_on_a_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = set()
    for r in docs:
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        expected.add((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op12_byte_bpe"](spark, SF).collect()} == expected


# ------------------------------------------------------------------ periodic runs

def runs_brute(words, least):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)      # the smallest period of a stretch comes first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def _texts(rng):
    for k in range(900):
        letters = "abcd"[:rng.choice([1, 2, 2, 3, 4])]
        if k % 3 == 0:
            yield rng.choices(letters, k=rng.randint(0, 60))
        elif k % 3 == 1:
            yield [w for _ in range(rng.randint(0, 6)) for w in rng.choices(letters, k=rng.randint(1, 9)) * rng.randint(1, 6)]
        else:
            a, b = ["a"], ["a", "b"]
            for _ in range(rng.randint(1, 7)):
                a, b = b, b + a
            b = b[rng.randint(0, 5):]
            if k % 2 and b:
                b[rng.randrange(len(b))] = "c"
            yield b
    for x in range(1, 20):                               # aligned only at the ends of their progressions
        yield ["a", "b"] * x + ["a"] + ["a", "b"] * (20 - x) + ["a"]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_are_brute_force(least):
    for words in _texts(random.Random(least)):
        assert list(map(tuple, periodic.runs([w.encode() for w in words], least).tolist())) == runs_brute(words, least)


def test_runs_of_long_texts():
    one = [b"a"] * 30_000
    assert periodic.runs(one).tolist() == [[0, 30_000, 1]]
    assert len(periodic.runs([b"a", b"b"] * 5000 + [b"a"] + [b"a", b"b"] * 5000)) == 4999


def _expected(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_brute(w, 12)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_op13_rows(spark, rows):
    rng = random.Random(5)
    data = [(i, " \t".join(rng.choices(["x", "yy", "Z", "é", " "], k=rng.randint(0, 90)))) for i in range(150)]
    data += [(None, "a b " * 20), (BIG, None), (BIG, "a  b\n" * 40), (7, "one two\x0bthree " * 300), (7, "one two\x0bthree " * 300), (8, ""), (9, " \t ")]
    data += [(k, "") for k in range(1000, 1300)] + [(k, "solo") for k in range(1000, 1300)]
    got = periodic.digests(periodic.find(periodic.with_planted(rows(data, "doc_id long, text string")))).collect()
    assert Counter(map(tuple, got)) == Counter(_expected(*d) for d in data)
    assert periodic.find(rows([], "doc_id long, text string")).count() == 0


def test_op13_outputs(spark, rows):
    r = periodic.find(rows([(1, "intro " + "ring the bell " * 5 + "end")], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(1, 15, 3)] and r.collapsed == "intro ring the bell end"


def test_op13_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 6000").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(docs) > 100 and all(got[r.doc_id] == _expected(r.doc_id, r.text) for r in docs)
