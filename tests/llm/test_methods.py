"""Each method against brute force, an exact round trip, a public library or held-out labels."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from medalloy.llm import bagminhash as bm
from medalloy.llm import bpe, decontam, langid, pivot_search, queries, secrets
from medalloy.llm.shingles import multiset, overlap, word_hashes


def texts_of(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def test_codec_equals_the_public_library(spark, sf):
    import public_tokenizers as P
    import tiktoken

    vocab = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(vocab)}, special_tokens={})
    ours = bpe.Codec(vocab, P.PATTERN)
    rng = random.Random(4)
    odd = ["", "a" * 3000, "\x1c\x1d a", "x²y ½ ٣٤", "日本語 1२3", "I'm we've  \n\n x", "_a__b_ 12", "\x85\xa0 ", "<|endoftext|>"]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD000)])) for _ in range(60)) for _ in range(60)]
    for t in odd:
        assert ours.encode([t])[0] == theirs.encode_ordinary(t) and ours.decode(ours.encode([t])[0]) == t.encode()
    got = {r.doc_id: r for r in queries.op8_bpe_codec(spark, sf).collect()}
    for i, t in texts_of(spark, sf).items():
        ids = theirs.encode_ordinary(t)
        assert got[i].n_tokens == len(ids) and got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_perfect_hash_is_minimal_and_perfect():
    tokens = [b"%d" % i for i in range(3000)]
    table = bpe.PerfectHash(tokens)
    assert table.lookup(tokens).tolist() == list(range(3000)) and sorted(table.slot_id.tolist()) == list(range(3000))


def test_signature_estimates_weighted_jaccard():
    rng = random.Random(3)
    for _ in range(12):
        a = {rng.getrandbits(64): rng.choice([1, 1, 2, 7, 40]) for _ in range(150)}
        b = {k: (v if rng.random() < 0.7 else rng.choice([1, 3, 50])) for k, v in a.items() if rng.random() < 0.9}
        sets = [(np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)])) for d in (a, b)]
        low, high = overlap(*sets)
        s = bm.signatures(sets, 2048)
        assert abs((s[0] == s[1]).mean() - low / high) < 0.06
        ref = (sets[0][0][:90], sets[0][1][:90])
        x, y = bm.difference(sets[0], ref), bm.difference(sets[1], ref)
        assert len(set(x)) == len(x) and len(set(x) ^ set(y)) == high - low


def edited(words, rng, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def test_classes_equal_brute_force(spark):
    """A large group of near copies of one text, chains, copies and texts that share a long passage."""
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(4000)}"
    texts, base, passage = [], [word() for _ in range(150)], [word() for _ in range(60)]
    texts += [edited(base, rng, rng.choice([0.005, 0.02, 0.03, 0.05])) for _ in range(160)]
    for _ in range(40):
        chain = [word() for _ in range(120)]
        for _ in range(3):
            texts.append(chain)
            chain = edited(chain, rng, 0.016)
    texts += [passage + [word() for _ in range(rng.randrange(5, 40))] for _ in range(60)]
    texts += [base[: 150 - k] for k in range(0, 40, 3)] + [texts[0], texts[5]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in bm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [multiset(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            low, high = overlap(sets[i], sets[j])
            if low * 5 >= high * 4:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    assert got == {i: top(i) for i in range(len(rows))}


def test_leaks_equal_brute_force(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    matcher = decontam.Matcher(items)
    rng = random.Random(5)
    texts = [t for t in texts_of(spark, sf).values() if 600 < len(t) < 4000][:40]
    want, got = set(), set()
    planted = []
    for k in range(120):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, 1 + len(words) // 5)):
            p = rng.randrange(len(words))
            words[p:p + rng.randrange(2)] = [f"q{rng.randrange(99)}"] * rng.randrange(2)
        around = rng.choice(texts).split()
        p = rng.randrange(len(around))
        planted.append(" ".join(around[:p] + words + around[p:]))
    for d, (t, hits) in enumerate(zip(planted, matcher.match(planted), strict=True)):
        w = word_hashes(t).tolist()
        got |= {(d, i) for i, *_ in hits}
        for i, b in items:
            x = word_hashes(b).tolist()
            k = decontam.allowed(len(x))
            if len(set(x) & set(w)) >= len(set(x)) - k and any(
                    min(decontam.prefix_distances(x, w[s:s + len(x) + k])) <= k for s in range(len(w))):
                want.add((d, i))
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 60


def test_prefix_distances_equal_the_table():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        row = list(range(len(a) + 1))
        want = [row[-1]]
        for w in b:
            new = [row[0] + 1]
            for i, x in enumerate(a, 1):
                new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != w)))
            row = new
            want.append(row[-1])
        assert decontam.prefix_distances(a, b) == want


def test_search_stops_early_and_exactly():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 60, (20, 16))
    c = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 3, (4000, 16)))
    q, ci, qi = c[:40], np.arange(4000), np.arange(40)
    got, made = pivot_search.search_block(qi, q, ci, c, pivot_search.choose_pivots(c[:500], 32), 5)
    scores = q @ c.T
    for i in range(40):
        order = sorted((j for j in range(4000) if j != i), key=lambda j: (-scores[i, j], j))[:5]
        assert [(a, b, s) for p, a, b, s in got if p == i] == [(i, j, int(scores[i, j])) for j in order]
    assert made < 0.6 * 40 * 4000


def test_base_spans_equal_plain_regexes(spark, sf):
    rules = [re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
             re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]
    names = ("assign", "access", "hex")
    got = {r.doc_id: r for r in queries.op6_secret_scan(spark, sf).collect()}
    for i, t in texts_of(spark, sf).items():
        spans = []
        for k, rule in enumerate(rules):
            for m in rule.finditer(t):
                if len(m.group(2) if k == 0 else m.group()) >= (6, 20, 24)[k]:
                    spans.append((m.start(), k, m.end()))
        text = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))


def test_battery_knows_random_from_structured():
    rng = random.Random(8)
    index = {c: i for i, c in enumerate("0123456789abcdef")}
    fair = [secrets.battery("".join(rng.choice("0123456789abcdef") for _ in range(40)), index) for _ in range(300)]
    assert sum(p < 0.01 for p in fair) < 15
    assert max(secrets.battery(t, index) for t in ("0123456789abcdef" * 3, "a" * 40, "0f" * 20)) < 1e-3


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(6)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    rows = [(i, "some ordinary words of a text " * 20 + "photosynthesis4internationalisation") for i in range(50)]
    rows[7] = (7, f"before {key} after")
    found = {r.doc_id: r.spans for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.kind, s.start, s.end) for s in found[7]] == [("random", 7, 47)]
    assert not any(s for i, s in found.items() if i != 7)


def test_automaton_phrases_equal_brute_force():
    rng = random.Random(9)
    for _ in range(150):
        text, s = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randrange(1, 30), rng.randrange(1, 25)))
        s += rng.choice(["", "d", "dd"])
        n, at = 0, 0
        while at < len(s):
            size = 1
            while at + size < len(s) and s[at:at + size + 1] in text:
                size += 1
            n, at = n + 1, at + size
        assert langid.SuffixAutomaton(text).phrases(s) == n


@pytest.mark.parametrize("name,label,least", [("op5_cross_parsing_language", "lang", 0.97), ("op7_kernel_quality", "quality", 0.95),
                                              ("op10_boosted_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf).where("held_out")
    known = spark.read.parquet(f"{sf}/{'documents' if label == 'lang' else 'labels'}.parquet").select("doc_id", label)
    guess = "lang_pred" if label == "lang" else "predicted"
    rows = got.join(known, "doc_id").where(f"{label} is not null").select(guess, label).collect()
    assert len(rows) > 50 and sum(a == b for a, b in rows) >= least * len(rows)


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n, names = docs.columns, docs.count(), [k for k, _ in cp.STAGES]
    assert len(names) == 5 and cp.ORACLE_SQL is None
    dedup = cp.STAGES[1][1](spark, docs, sf)
    assert dedup.columns == columns
    classes = bm.near_duplicates(docs).collect()
    assert {r.doc_id for r in dedup.collect()} == {r.class_id for r in classes}
    clean = cp.STAGES[2][1](spark, docs, sf)
    leaked = {r.doc_id for r in queries.op2_cgk_leaks(spark, sf).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in classes} - leaked
    out = cp.run(spark, sf)
    assert set(out.columns) == {"doc_id", "lang", "source", "n_tokens", "ids"} and 0 < out.count() < n


def test_tests_under_ordinary_text_hold_and_decide(monkeypatch):
    """Each p-value is a bound for text drawn from the model; random keys pass; both sides of the battery decide."""
    rng = random.Random(31)
    letters = "etaoinshrdlucmfwypvbgkjqxz"
    counts = {c: 4000 // (i + 1) for i, c in enumerate(letters)} | {c: 40 for c in "ETAOIN0123456789"}
    model = secrets.TextModel(counts, 100_000, 2_000)
    abc = dict(secrets.ENCODINGS)["base62"]
    for n in (16, 24, 40):
        drawn = [model.tests("".join(rng.choices(abc, [counts.get(c, 0) + 1 for c in abc], k=n)), "base62") for _ in range(1500)]
        for which in (0, 2):  # the runs test's null is the rate of changes, not single symbols
            for level in (0.3, 0.1, 0.03, 0.01):
                assert sum(t[which] <= math.log(level) for t in drawn) <= 1500 * level + 3 * (1500 * level) ** 0.5
        for _ in range(200):  # kinds that change at the model's rate
            kinds, token = rng.randrange(3), ""
            for _ in range(n):
                kinds = (kinds + 1) % 3 if rng.random() < model.change else kinds
                token += rng.choice(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")[kinds])
            changes = sum(a.isdigit() != b.isdigit() or a.islower() != b.islower() for a, b in zip(token, token[1:], strict=False))
            exact = sum(math.comb(n - 1, x) * model.change ** x * (1 - model.change) ** (n - 1 - x) for x in range(changes, n))
            assert model.tests(token, "base62")[1] >= math.log(exact) - 1e-9
    key = "".join(rng.choice(abc) for _ in range(40)) + "7"
    assert model.log_p(key, "base62") < -30
    limits = {c: -160 for c in range(4, 9)}
    text = f"some words {key} and {'0123456789abcdefABCDEF' * 2} more"
    at = text.index(key)
    assert secrets.scan(text, model, limits) == [(at, 3, at + len(key))]
    monkeypatch.setattr(secrets, "battery", lambda token, index: 1.0)
    assert len(secrets.scan(text, model, limits)) == 2
    monkeypatch.setattr(secrets.TextModel, "tests", lambda self, token, name: (0.0, 0.0, 0.0))
    assert secrets.scan(text, model, limits) == []
