"""Operators on documents against brute force on small tables."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymark.llm import decontaminate, mixing, order_minhash, pii, repeats, toxicity

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# ------------------------------------------------------------------ spaced seeds

def test_masks_are_lossless():
    """Every placement of the allowed substitutions leaves a mask that fits between them."""
    for width, wrong, masks in [(decontaminate.WIDTH, decontaminate.WIDTH - decontaminate.NEED, decontaminate.MASKS)] + \
            [(n, max(0, n // 5 - 1), [decontaminate.SHORT_MASK]) for n in range(decontaminate.MIN_TOKENS, decontaminate.WIDTH)]:
        for bad in itertools.combinations(range(width), wrong):
            assert any(not {o + m for m in mask} & set(bad) for mask in masks for o in range(width - mask[-1])), (width, bad)


def overlap_brute(doc, item):
    """Most equal tokens on an alignment that qualifies, or 0."""
    n, best = len(item), 0
    if n < decontaminate.MIN_TOKENS:
        return 0
    need = decontaminate.NEED if n >= decontaminate.WIDTH else n - max(0, n // 5 - 1)
    for d in range(-n, len(doc) + 1):
        eq = [j for j in range(n) if 0 <= d + j < len(doc) and doc[d + j] == item[j]]
        if any(eq[i + need - 1] - eq[i] < decontaminate.WIDTH for i in range(len(eq) - need + 1)):
            best = max(best, len(eq))
    return best


def test_decontamination_brute_force(spark, rows):
    rng = random.Random(3)
    items = [prose(rng, n).split() for n in (6, 8, 9, 12, 15, 17, 18, 25, 60)]
    docs = []
    for i in range(60):
        doc = prose(rng, rng.randint(0, 60)).split()
        if i % 3:
            item = list(rng.choice(items))
            lo = rng.randint(0, max(0, len(item) - 18))
            part = item[lo:lo + rng.choice([12, 16, 18, 22, 80])]
            for _ in range(rng.randint(0, 5)):
                part[rng.randrange(len(part))] = rng.choice(WORDS)
            at = rng.randint(0, len(doc))
            doc[at:at] = part
        docs.append(doc)
    table = rows([(i, ", ".join(d).upper()) for i, d in enumerate(docs)] + [(None, None), (90, ""), (91, "...")],
                 "doc_id long, text string")
    bench = rows([(j, " ".join(x)) for j, x in enumerate(items)] + [(99, None), (98, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.contaminated(table, bench).collect()}
    want = {(i, j): n for i, d in enumerate(docs) for j, x in enumerate(items) if (n := overlap_brute(d, x))}
    assert got == want and len(want) > 10
    kept = {r.doc_id for r in decontaminate.clean(table, bench).select("doc_id").collect()}
    assert kept == {None, 90, 91, *range(60)} - {i for i, _ in want}
    assert decontaminate.contaminated(table.limit(0), bench).count() == 0
    assert decontaminate.clean(table, bench.limit(0)).count() == 63


def test_decontamination_hashes_positions_in_rows(spark, rows):
    """Seeds of a text are hashed in compiled rows, not by a lambda over its positions; texts too short
    for a seed and separators alone match nothing."""
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = rows([(1, f"x {item} y"), (2, ""), (3, " ,;"), (4, "alpha beta gamma delta"), (5, item), (6, None),
                 (7, "alpha beta gamma delta epsilon")], "doc_id long, text string")
    bench = rows([(1, item)], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench)
    assert sorted((r.doc_id, r.item_id, r.n_equal) for r in found.collect()) == [(1, 1, 8), (5, 1, 8)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(2" in plan and not any("lambdafunction(CASE WHEN" in x and "xxhash64(2" in x for x in plan.split("\n"))


# ------------------------------------------------------------------ Order MinHash

def edited(rng, ws, k):
    ws = list(ws)
    for _ in range(k):
        at = rng.randrange(len(ws))
        ws[at:at + 1] = rng.choice([[], ["new" + str(rng.random())[2:8]], [ws[at], "ins" + str(rng.random())[2:8]]])
    return ws


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            row[j + 1], prev = (prev + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


def test_banded_alignment_is_exact_above_its_bound():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randint(1, 40))]
        b = edited(rng, a, rng.randint(0, 8)) if rng.random() < .7 else [rng.randrange(12) for _ in range(20)]
        b = [x if isinstance(x, int) else hash(x) for x in b]
        lcs = plain_lcs(a, b)
        for need in (lcs, max(0, lcs - 2)):
            assert order_minhash.matched(a, b, need) == lcs
        assert order_minhash.matched(a, b, lcs + 1) <= lcs


def near_brute(texts):
    g = {i: order_minhash.shingles(t).tolist() for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sorted(texts), 2):
        m = plain_lcs(g[a], g[b])
        if m and m / (len(g[a]) + len(g[b]) - m) >= order_minhash.SIMILARITY:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in texts}


def test_near_duplicates_brute_force(spark, rows):
    rng = random.Random(7)
    texts, n = {}, 0
    shared = prose(rng, 60)
    for _ in range(12):
        base = prose(rng, rng.choice([3, 9, 30, 120])).split()
        for _ in range(rng.randint(1, 5)):
            texts[n] = " ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 60)))); n += 1
    for _ in range(8):                                    # a common passage is no duplicate
        texts[n] = shared + " " + prose(rng, rng.randint(40, 90)); n += 1
    chain = prose(rng, 200).split()
    for _ in range(6):                                    # a chain: ends alike only through the middle
        texts[n] = " ".join(chain); n += 1
        chain = edited(rng, chain, 3)
    texts[n] = texts[0].upper(); n += 1
    table = rows([(i, t) for i, t in texts.items()] + [(200, ""), (201, None), (202, " \n"), (None, "x y"), (0, texts[0])],
                 "doc_id long, text string")
    out = order_minhash.near_duplicates(table).collect()
    got = {r.doc_id: r.class_id for r in out}
    assert len(out) == len(texts) + 5
    want = near_brute({i: t for i, t in texts.items() if t})
    assert {i: got[i] for i in want} == want
    assert [got[i] for i in (200, 201, 202, None)] == [200, 201, 202, None]
    assert all(r.kept == (r.doc_id == r.class_id) for r in out if r.doc_id is not None)
    assert order_minhash.near_duplicates(table.limit(0)).count() == 0


def test_near_duplicates_of_repeated_ids(spark, rows):
    """Two texts under one id, one text under two ids, a row twice, ids beyond 2^53 beside nulls."""
    rng = random.Random(8)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    big = 2 ** 53 + 1
    data = [(5, a), (5, b), (2, b), (7, c), (7, c), (big, d), (big + 1, d), (None, d), (None, None), (9, None), (9, ""), (9, "")]
    out = order_minhash.near_duplicates(rows(data, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id, r.kept) for r in out) == Counter(
        [(5, 5, True), (5, 2, False), (2, 2, True), (7, 7, True), (7, 7, True), (big, big, True), (big + 1, big, False),
         (None, None, True), (None, None, True), (9, 9, True), (9, 9, True), (9, 9, True)])
    kept = order_minhash.deduplicate(rows(data, "doc_id long, text string"))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(5, a), (2, b), (7, c), (big, d), (None, d), (None, None), (9, None), (9, ""), (9, "")])
    assert kept.columns == rows(data, "doc_id long, text string").columns


def test_every_text_gets_the_same_number_of_keys():
    rng = random.Random(2)
    for n in (1, 3, 20, order_minhash.SHORT, order_minhash.SHORT + 1, 500):
        g = order_minhash.shingles(prose(rng, n + 4))
        assert len(g) == n
        assert len(order_minhash.sketch(g)) == order_minhash.TABLES + (order_minhash.SHORT_TABLES if n <= order_minhash.SHORT else 0)


def test_near_duplicates_across_a_common_passage(spark, rows, monkeypatch):
    """Large mixed buckets: many texts that share a passage, some of them copies in pairs."""
    monkeypatch.setattr(order_minhash, "FEW", 4)
    monkeypatch.setattr(order_minhash, "SIDE", 8)
    rng = random.Random(12)
    common = prose(rng, 70)
    texts = {}
    for i in range(60):
        own = prose(rng, rng.choice([4, 9, 15, 40])).split()
        texts[2 * i] = common + " " + " ".join(own)
        own[rng.randrange(len(own))] = "changed"
        texts[2 * i + 1] = common + " " + " ".join(own)
    out = order_minhash.near_duplicates(rows(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in out} == near_brute(texts)


# ------------------------------------------------------------------ mixing

def test_poisson_rates_and_determinism(spark, rows):
    data = [(i, "a" if i % 10 else ("b" if i % 20 else None), None if i % 7 == 0 else f"t{i}") for i in range(4000)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string")
    out = mixing.replicate(docs, {"a": 1.0, "b": 1.0, "zero": 0.0}, epochs=2.0)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"a", "b"} and abs(n["a"] - 4000) < 320 and abs(n["b"] - 4000) < 320
    again = mixing.replicate(docs.repartition(7), {"a": 1.0, "b": 1.0}, epochs=2.0)
    key = lambda df: sorted(map(tuple, df.select("doc_id", "part", "copy", "shuffle_key").collect()))
    assert key(out) == key(again)
    per = Counter(r.doc_id for r in out.where("source = 'a'").collect())
    counts = Counter(per.get(i, 0) for i, s, _ in data if s == "a")
    rate = 2.0 * 4000 * .5 / 3600
    for k in range(4):                                    # the copies follow the distribution
        p = np.exp(-rate) * rate ** k / [1, 1, 2, 6][k]
        assert abs(counts[k] / 3600 - p) < 0.03
    orders = [r.shuffle_key for r in out.collect()]
    assert len(set(orders)) == len(orders)
    assert mixing.replicate(docs.limit(0)).count() == 0 and mixing.replicate(docs, {}).count() == 0
    clash = mixing.replicate(rows(data[:50], "doc_id long, source string, text string"))
    assert clash.columns.count("part") == 1 and dict(clash.dtypes)["copy"] == "int"


def test_rare_source_with_high_rate(spark):
    docs = spark.createDataFrame([(i, "big") for i in range(999)] + [(None, "rare")], "doc_id long, source string")
    n = {r.source: r["count"] for r in mixing.replicate(docs, {"big": 1, "rare": 1}).groupBy("source").count().collect()}
    assert abs(n["rare"] - 500) < 120                     # rate 500, as 32 draws


# ------------------------------------------------------------------ pseudonyms

def luhn_ok(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark, rows):
    texts = ["a 4041894974608795 b", "4041 8949 7460 8795", "card 4041894974608796 is wrong", "on 2024-02-29, not 2023-02-30",
             "29/02/2024", "42.144.35.254 and 999.1.1.1", "+1 (988) 555-2485", "+1 988 555 2485", "brd.27@mail8.example.com",
             "123-45-6789 000-45-6789", "", None, "nothing 12 here", "x@y", "4041894974608795" * 1]
    out = [r for r in pii.pseudonymise(rows([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "key")
           .orderBy("doc_id").collect()]
    got = [r.text for r in out]
    assert luhn_ok(got[1]) and got[0] == "a " + got[1].replace(" ", "") + " b" and got[14] == got[1].replace(" ", "")
    assert got[1] != texts[1] and got[2] == texts[2] and got[3].endswith("not 2023-02-30")
    iso, dmy = got[3][3:13], got[4]
    assert iso != "2024-02-29" and dmy == "/".join(iso.split("-")[::-1])
    assert got[5].endswith("and 999.1.1.1") and all(int(x) < 256 for x in got[5].split(" ")[0].split("."))
    digits = lambda s: "".join(c for c in s if c.isdigit())
    assert digits(got[6]) == digits(got[7]) != digits(texts[6]) and got[6].startswith("+1 (")
    assert got[8] != texts[8] and got[8].endswith(".com") and [c.isalpha() for c in got[8]] == [c.isalpha() for c in texts[8]]
    assert got[9].split()[1] == "000-45-6789" and got[9].split()[0] != "123-45-6789"
    assert got[10:14] == texts[10:14] and [r.n_pii for r in out[10:14]] == [0, 0, 0, 0]
    other = pii.pseudonymise(rows([(0, texts[0])], "doc_id long, text string"), "other key").first().text
    assert other != got[0]
    assert pii.pseudonymise(rows([], "doc_id long, text string"), "key").count() == 0


def test_cards_beside_other_numbers(spark, rows):
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    texts = [card, f"card {card} 12/27", f"{spaced} 123", f"no 12 {card}", "call 123 555-123-4567", f"1234 {spaced} 12/27 7",
             f"{card} 2024-02-29 {spaced}", f"{card} 555.123.4567", f"{card} 10.1.2.3", "378282246310005", "3782-822463-10005 1234",
             "1 2 3 4 5 6 7 8 9 10 11 12 13 14", f"{card} 12bob@mail.example.com", "555-123-4567", "2024-02-29", "10.1.2.3",
             "12bob@mail.example.com", "555.123.4567", "41111 11111 11111 1", "1 " * 20000]
    out = pii.pseudonymise(rows([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "key").orderBy("doc_id").collect()
    got, n = [r.text for r in out], [r.n_pii for r in out]
    new = got[0]
    four = " ".join(new[i:i + 4] for i in range(0, 16, 4))
    assert new != card and luhn_ok(new)
    assert got[1:4] == [f"card {new} 12/27", f"{four} 123", f"no 12 {new}"]
    assert got[4] == "call 123 " + got[13] != texts[4] and got[5] == f"1234 {four} 12/27 7"
    assert got[6] == f"{new} {got[14]} {four}" and got[7] == f"{new} {got[17]}" and got[8] == f"{new} {got[15]}"
    amex = got[9]
    assert amex != texts[9] and got[10] == f"{amex[:4]}-{amex[4:10]}-{amex[10:]} 1234"
    assert got[11] == texts[11] and got[12] == f"{new} {got[16]}" and got[18].replace(" ", "") == new and got[19] == texts[19]
    assert n == [1, 1, 1, 1, 1, 1, 3, 2, 2, 1, 1, 0, 2, 1, 1, 1, 1, 1, 1, 0]


def test_feistel_is_a_bijection(spark):
    from pyspark.sql import functions as F
    two = spark.range(100).select(pii.permuted_string(F.format_string("%02d", "id"), "k", "t").alias("p"))
    assert two.distinct().count() == 100
    n = spark.range(81).select(pii.permuted_number(F.col("id"), 9, "k", "t").alias("p"))
    assert sorted(r.p for r in n.collect()) == list(range(81))


# ------------------------------------------------------------------ toxicity

def test_classifier_learns_and_ignores_groups(spark, rows):
    rng = random.Random(11)
    bad, docs, labels = ["vile", "scumbag", "hatefulness"], [], []
    for i in range(1200):
        ws = prose(rng, rng.randint(5, 80)).split()
        y = int(i % 4 == 0)
        if y:
            ws.insert(rng.randrange(len(ws)), rng.choice(bad))
        # One group is named mostly in toxic texts, another mostly in clean ones.
        if rng.random() < .5:
            ws.insert(rng.randrange(len(ws)), "muslims" if (rng.random() < .9) == bool(y) else "christians")
        docs.append((i, " ".join(ws)))
        labels.append((i, y))
    d = rows(docs + [(5000, None), (5001, ""), (None, "vile")], "doc_id long, text string")
    lab = rows(labels + [(None, 1), (7, None), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(d, lab)
    got = {r.doc_id: r for r in toxicity.scores(d, model).collect()}
    assert len(got) == 1203
    held = [i for i, _ in docs if got[i].held_out]
    truth = dict(labels)
    assert 150 < len(held) < 330 and np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    free = toxicity.fit(d, lab, pairing=0.0)
    gap = lambda m: abs(m.weights["w:muslims"] - m.weights["w:christians"])
    assert gap(model) < 0.25 * gap(free)                  # the penalty takes the group out of the score
    assert got[5000].score == got[5001].score < 0.5 and got[None].held_out and got[None].predicted == 1
    assert {r.doc_id for r in toxicity.reject(d, model).select("doc_id").collect()} == {i for i in got if got[i].predicted == 0}
    for empty in (toxicity.fit(d, lab.limit(0)), toxicity.fit(d.limit(0), lab)):
        assert {r.predicted for r in toxicity.scores(d, empty).collect()} == {0}
    assert toxicity.scores(d.limit(0), model).count() == 0


# ------------------------------------------------------------------ repeats

def repeats_brute(texts, window):
    ws = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[s:s + window]) for w in ws for s in range(len(w) - window + 1))
    out = []
    for w in ws:
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] > 1:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window, gram", [(35, 8), (6, 2)])
def test_repeats_brute_force(spark, rows, window, gram):
    rng = random.Random(window)
    passage, texts = prose(rng, 60), []
    for i in range(40):
        a, b = prose(rng, rng.randint(0, 50)), prose(rng, rng.randint(0, 50))
        cut = passage.split()[rng.randint(0, 10):60 - rng.randint(0, 10)]
        if i % 4 == 0:
            cut[rng.randrange(len(cut))] = f"odd{i}"
        texts.append(f"{a}\n {' '.join(cut)}\t{b}" if i % 2 else a + " " + b)
    texts += [texts[1], texts[1], "a " * 90, "x y z " * 30, "é ü " * 40, "", None, " \t\n", passage * 3]
    table = rows(list(enumerate(texts)) + [(3, texts[3]), (None, texts[5])], "doc_id long, text string")
    got = sorted([(-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                  for r in repeats.remove_repeats(table, window=window, gram=gram).collect()])
    all_texts = [*texts, texts[3], texts[5]]
    want = sorted([(i, *x) for i, x in zip([*range(len(texts)), 3, -1], repeats_brute(all_texts, window))])
    assert got == want and sum(x[2] for x in want) > 500
    assert repeats.remove_repeats(table.limit(0)).count() == 0


def test_repeats_compile_what_a_shard_can_hold(monkeypatch):
    """Of a common minimizer's passages a shard compiles those of its own texts, some at a time."""
    import pandas as pd
    rng, sizes, real = random.Random(3), [], repeats.ahocorasick.Automaton

    class Machine:
        def __init__(self, *a):
            self.inner, self.n = real(*a), 0

        def add_word(self, w):
            self.n += 1
            self.inner.add_word(w)

        def make_automaton(self):
            sizes.append(self.n)
            self.inner.make_automaton()

        def __len__(self):
            return len(self.inner)

        def iter(self, s):
            return self.inner.iter(s)

    passages = [" ".join(prose(rng, 40).split()[:40]) for _ in range(400)]
    texts = ["start " + p + " end" for p in passages[:30]] + [None, "a b c"]
    monkeypatch.setattr(repeats.ahocorasick, "Automaton", Machine)
    monkeypatch.setattr(repeats, "MACHINE_WORDS", 400, raising=False)
    located = repeats._located(8) if repeats._located.__code__.co_argcount == 1 else repeats._located
    got = located((0,), pd.DataFrame({"k": range(len(texts)), "text": texts}), pd.DataFrame({"words": [p.encode() for p in passages]}))
    assert got["n_removed"].tolist() == [len(p.split()) for p in passages[:30]] + [0, 0]
    assert max(sizes) <= 10 and sum(sizes) == 30


def test_repeats_keep_large_ids(spark, rows):
    big = 2 ** 53 + 1
    got = repeats.remove_repeats(rows([(big, "a b"), (None, "a b"), (big + 1, None)], "doc_id long, text string"))
    assert Counter((r.doc_id, r.n_words) for r in got.collect()) == Counter([(big, 2), (None, 2), (big + 1, 0)])


# ------------------------------------------------------------------ toxicity, repeated ids

def test_training_rows_of_repeated_ids(spark, rows):
    """A labelled id that repeats teaches with one text; ids beyond 2^53 beside nulls stay."""
    big = 2 ** 53 + 1
    docs = rows([(i % 4 + 1, f"text {i}") for i in range(400)] + [(None, "x"), (big, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, 0), (None, 1)], "doc_id long, toxic int")
    train, sizes = toxicity.training_texts(docs, labels)
    learned = [i for i in (1, 2, 3, 4) if spark.range(1).select(~toxicity.held_out(toxicity.F.lit(i))).first()[0]]
    assert train.count() == len(learned)
    got = toxicity.scores(docs, toxicity.Model({"w:x": 5.0}, -3.0))
    assert {r.doc_id for r in got.collect()} == {1, 2, 3, 4, None, big}
    kept = toxicity.reject(docs.withColumn("m", toxicity.F.lit(big)), toxicity.Model({"w:x": 5.0}, -3.0))
    assert kept.count() == 401 and kept.where(f"m <> {big}").count() == 0 and kept.columns == [*docs.columns, "m"]
