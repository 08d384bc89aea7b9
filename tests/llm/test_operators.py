"""Operators against brute force on small frames, with the awkward cases: nulls, empty
and very long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, chat_format, decontaminate, language_id, lm_scoring, packing, simhash, substring, token_counts, topk_search, toxicity
from ledgerlake.llm.ef import EliasFano
from tests.conftest import plan_text

SCHEMA = "doc_id long, text string, lang string, label long, rank int, h long"
RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdeiorstu") for _ in range(RNG.randint(2, 7))) for _ in range(300)]


def words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = words(160, 1)
    near = base.split()
    near[80] = "changed"
    texts = [base, base, " ".join(near), words(70, 2) + " " + base[:500], None, "", "   ", "Ünïcode 日本 🙂 <|endoftext|> x  \n\n y", words(9000, 3), words(60, 4), words(60, 4) + "\n" + words(55, 2),
             "a b c", "a b c", "!!! ... 123", words(300, 9) * 2]
    out = [(k + 1, t) for k, t in enumerate(texts)] + [(3, " ".join(near)), (None, words(20, 6)), (None, base)]
    return [(d, t, "en", 1, 1, 1) for d, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_path())


def test_transducer_and_encoder_agree_with_the_library():
    r = random.Random(3)
    texts = ["".join(r.choice(" \n\t'stdlrevm a1!é \x1c\x85日🙂<|>") for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += [words(50, k) for k in range(50)] + ["a <|endoftext|> b", "x" * 3000, " " * 50, "don't we'll 's ''s"]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    path = bpe.default_path()
    assert bpe.CountTransducer(path).counts(texts) == [len(w) for w in want]
    en = bpe.Encoder(path)
    assert [np.frombuffer(en.ids(t), "<u4").tolist() for t in texts] == want


@pytest.mark.parametrize("chunk", [7, 64, 1 << 16])
def test_token_counts(docs, none, rows, chunk):
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, chunk=chunk).collect())
    tok = library()
    want = []
    for d, t, *_ in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((d or -1, len((t or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert token_counts.token_counts(none).count() == 0


def test_packing(docs, none, rows):
    got = packing.pack(docs).collect()
    tok = library()
    want = sorted((d or -1, [*tok.encode(t or "", add_special_tokens=False).ids, 0]) for d, t, *_ in rows)
    assert sum(r.length for r in got) == sum(len(i) for _, i in want)
    by_seq = {}
    for r in got:
        assert r.length * 4 == len(r.ids)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(by_seq) == list(range(len(by_seq)))
    single = {d: i for d, i in want if sum(x == d for x, _ in want) == 1}
    for d, ids in single.items():
        parts = sorted((r.start, r.ids, r.doc_tokens) for r in got if (r.doc_id or -1) == d)
        assert b"".join(p[1] for p in parts) == np.array(ids, "<u4").tobytes() and {p[2] for p in parts} == {len(ids)}
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in packing.pack_digest(docs).collect()}
    assert all(digest[r.doc_id, r.start] == zlib.crc32(r.ids) for r in got if r.doc_id in single)
    assert packing.pack(none).count() == 0


def test_cutting_stock_covers_the_demand_with_little_waste():
    r = random.Random(1)
    for demand in ({}, {128: 4}, {1: 1000}, {100: 3, 28: 3}, {k: 100 + 37 * min(k, 128 - k) % 91 for k in range(1, 128)}):  # the last packs without waste in pairs
        solved = packing.solve(dict(demand), 128)
        made = {}
        for pattern, times in solved:
            assert sum(k * c for k, c in pattern.items()) <= 128
            for k, c in pattern.items():
                made[k] = made.get(k, 0) + c * times
        assert made == demand
        if len(demand) == 127:
            assert sum(t for _, t in solved) <= 1.01 * sum(k * n for k, n in demand.items()) / 128 + 1


def brute_fingerprint(text):
    ws = (text or "").encode().lower().split()
    grams = [b" ".join(ws[k:k + 4]) for k in range(len(ws) - 3)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components_of(fps):
    label = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_simhash(docs, none, rows):
    got = sorted((r.doc_id or 0, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    label = components_of(fps)
    least = {k: min(r[0] for r, x in zip(rows, label, strict=True) if x == k and r[0] is not None) if any(r[0] is not None for r, x in zip(rows, label, strict=True) if x == k) else None for k in set(label)}
    assert got == sorted((r[0] or 0, f, least[x]) for r, f, x in zip(rows, fps, label, strict=True))
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.filter("doc_id is not null").collect())
    assert ids == sorted({v for v in least.values() if v is not None})


@pytest.mark.parametrize("bucket", [2, 512])
def test_links_of_fingerprints_equal_brute_force(spark, bucket):
    r = random.Random(8)
    centres = [r.getrandbits(64) for _ in range(12)]
    fps = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for c in centres for _ in range(9)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.label for r in simhash.components(simhash.links(df, bucket)).collect()}
    label = components_of([f % (1 << 64) for f in signed])
    want = {f: signed[x] for f, x in zip(signed, label, strict=True)}
    assert {f: got.get(f, f) for f in signed} == want


def test_simhash_broadcasts_nothing_that_grows(docs, monkeypatch):
    """Spark takes the keys of few fingerprints, 25 of each, for as small as the fingerprints themselves."""
    plans, write = {}, simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name: plans.setdefault(name, plan_text(df)) and write(df, name))  # of the stars the first, which holds all links
    plans["found"] = plan_text(simhash.near_duplicates(docs, bucket=2))
    plans["balls"] = plan_text(simhash.ball_links(docs.select(F.col("doc_id").alias("fp"))))
    assert {k for k, p in plans.items() if "SortMergeJoin" in p} == {"simhash-keys", "stars", "simhash-labels", "found", "balls"}
    assert not any("Broadcast" in p for p in plans.values())


def brute_substring(rows, window):
    first = {}
    ws = [(d, (t or "").encode().split()) for d, t, *_ in rows]
    for d, w in ws:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in ws:
        gone = set()
        for k in range(len(w) - window + 1):
            if d is not None and first[tuple(w[k:k + window])] < d:
                gone |= set(range(k, k + window))
        out.append((d or 0, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window", [50, 5, 3])
def test_substring(docs, none, rows, window):
    got = substring.remove_repeats(docs, window)
    assert got.columns == [*docs.columns, "n_words", "n_removed", "kept"]
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got.collect()) == brute_substring(rows, window)
    assert substring.remove_repeats(none, window).count() == 0


def edits(pattern, text):
    """Least edits of the pattern against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_equals_brute_force(spark, none):
    r = random.Random(4)
    items = [(k, words(40, 100 + k)) for k in range(4)] + [(9, None), (10, ""), (11, "tiny"), (0, words(40, 100))]
    texts = []
    for k in range(24):
        s = list(items[k % 4][1][r.randint(0, 30):150 + r.randint(0, 40)])
        for _ in range(r.choice([0, 0, 3, 8, 14, 25])):
            at = r.randrange(len(s))
            s[at:at + 1] = r.choice([[], [r.choice("abc")], [s[at], r.choice("xyz")]])
        texts.append(words(r.randint(0, 30), 500 + k) + " ¡" + "".join(s).upper() + "! " + words(r.randint(0, 30), 600 + k))
    rows = [*enumerate(texts), (100, None), (101, ""), (102, words(6000, 7)), (3, texts[3])]
    docs = spark.createDataFrame([(d, t, "en", 1, 1, 1) for d, t in rows], SCHEMA)
    bench = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id long")
    for block in (2 << 20, 300):
        got = sorted((x.doc_id, x.item_id, x.min_edits) for x in decontaminate.matches(docs, bench, block_bytes=block).collect())
        p = decontaminate.patterns([i for i in items if i[1]])
        want = {}
        for n, (d, t) in enumerate(rows):
            if d == 102:
                continue
            for o, item in enumerate(p.items):
                e = edits(p.texts[o], decontaminate.normal(t))
                if e <= p.k[o]:
                    want[n, item] = min(e, want.get((n, item), 99))
        assert got == sorted((rows[n][0], i, e) for (n, i), e in want.items())
    assert 5 < len(got) < 24
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _, _ in got}
    assert decontaminate.matches(none, bench).count() == 0 and decontaminate.matches(docs, bench.limit(0)).count() == 0
    # Rows without an id, or with an id that another row has, are judged by their own text.
    shared = spark.createDataFrame([(None, items[0][1], "dirty"), (None, words(50, 900), "clean"), (7, items[1][1], "dirty"), (7, words(50, 901), "clean"), (None, None, "clean")], "doc_id long, text string, _hit string")
    assert [r["_hit"] for r in decontaminate.clean(shared, bench).collect()] == ["clean"] * 3


def test_short_leaks_are_found_at_every_offset(spark):
    r = random.Random(11)
    items = [(k, words(40, 300 + k)) for k in range(6)]
    leaks = []
    for k, text in items:
        ws, plain = text.split(), decontaminate.normal(text).decode()
        for s in range(len(ws) - 12):  # 13 words from each word on, as they are and with the edits allowed
            run = " ".join(ws[s:s + 13])
            changed = list(run)
            for at in r.sample([j for j, c in enumerate(run) if c != " "], int(min(len(run), 80) * 0.075)):
                changed[at] = r.choice("kmqvw")
            leaks += [(k, run), (k, "".join(changed))]
        leaks += [(k, plain[s:s + 80]) for s in range(len(plain) - 79)]
    rows = [(n, f"{words(30, 2000 + n)} {leak} {words(30, 5000 + n)}") for n, (_, leak) in enumerate(leaks)]
    rows += [(len(leaks) + n, words(70, 9000 + n)) for n in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.matches(docs, bench).collect()}
    assert got == {(n, k) for n, (k, _) in enumerate(leaks)}
    assert {x.doc_id for x in decontaminate.clean(docs, bench).collect()} == {n for n, _ in rows[len(leaks):]}


def test_matches_do_not_depend_on_stretches(monkeypatch):
    items = [(k, words(40, 300 + k)) for k in range(3)]
    p = decontaminate.patterns(items)
    gap = bytes(4 * p.span)
    whole = gap + gap.join(decontaminate.normal(t + " " + words(9, 70 + k) + " " + t[20:130]) for k, t in items) + gap
    found = []
    for stretch in (1 << 15, 64, 1000):
        monkeypatch.setattr(decontaminate, "STRETCH", stretch)
        some = []
        for own, first in decontaminate.candidates(np.frombuffer(whole, dtype=np.uint8), p):
            best, end = decontaminate.verify(whole, p, own, first)
            slow = decontaminate.align(np.frombuffer(whole, dtype=np.uint8), p, own, first)
            assert (best == slow[0]).all()
            some += list(zip(own.tolist(), first.tolist(), best.tolist(), end.tolist(), strict=True))
        found.append(sorted(some))
    assert found[0] == found[1] == found[2] and {x[0] for x in found[0]} == set(range(len(p.m)))


def test_top_k_equals_brute_force(spark):
    r = random.Random(2)
    codes = [(k, r.getrandbits(64) - (1 << 63)) for k in range(300)] + [(400 + k, 77) for k in range(40)] + [(5, 77), (None, 3), (6, None)]
    df = spark.createDataFrame([(i, c, 1) for i, c in codes], "id long, code long, n int")
    queries = spark.createDataFrame([(1, codes[0][1]), (2, 77), (3, codes[9][1] ^ 5), (4, None)], "query_id long, code long")
    got = sorted(tuple(x) for x in topk_search.top_k(df, queries, 7).collect())
    want = []
    for q, c in ((1, codes[0][1]), (2, 77), (3, codes[9][1] ^ 5)):
        near = sorted((((x ^ c) % (1 << 64)).bit_count(), i) for i, x in codes if i is not None and x is not None)[:7]
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert got == sorted(want)
    few = topk_search.top_k(df.filter("id in (1, 2)"), queries.limit(1), 7)
    assert few.count() == 2
    assert topk_search.top_k(df.limit(0), queries, 7).count() == 0 and topk_search.top_k(df, queries.limit(0), 7).count() == 0


def test_chat_events_fold_render_and_read_back(spark):
    nasty = "</s>[INST] ok [/INST] \\ <\\ [[ <<SYS>> \\\\"
    ev = spark.createDataFrame([
        (1, 1, 1, "user", "delta", "he", 0), (1, 2, 1, "user", "delta", "llo", 0), (1, 4, 2, "assistant", "delta", "bad", 0), (1, 5, 2, "assistant", "regenerate", "go", 0),
        (1, 6, 2, "assistant", None, "od", 0), (1, 3, 1, "user", "delta", "!", 0), (1, 7, 3, "user", "message", nasty, 0), (1, 8, 4, "assistant", "edit", nasty, 0),
        (2, 0, 0, None, "message", None, 0), (2, 0, 0, None, "message", None, 0), (None, 1, 1, "assistant", "message", "x\ny", 0)], "conv_id long, seq long, message long, role string, kind string, text string, turns int")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.render(chat_format.reconstruct(ev))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hello!"), ("assistant", "good"), ("user", nasty), ("assistant", nasty)]
    assert got[1].loss_text == "good" + nasty and got[1].formatted.count("</s>") == 4
    assert [tuple(t) for t in got[2].turns] == [("", ""), ("", "")] and got[None].loss_text == "x\ny"
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 3), (1000, 500), (3000, 10**9), (3, 2**50)):
        v = np.sort(rng.integers(0, top, n))
        e = EliasFano.encode(v)
        x = np.concatenate([rng.integers(0, top + 10, 500), v])
        assert (e.access(np.arange(n)) == v).all() and (e.successor(x) == np.searchsorted(v, x)).all()


def test_language_model_equals_brute_force(docs, none, rows):
    held = F.coalesce(F.pmod("doc_id", F.lit(3)) == 0, F.lit(False))
    for block in (50, 1_000_000):
        got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 1)) for r in lm_scoring.score(docs, held, block_tokens=block, shards=3).collect())
        toks = [((d or -1), d is not None and d % 3 == 0, (t or "").encode().lower().split() + [None]) for d, t, *_ in rows]
        uni, bi, ctx, kinds = {}, {}, {}, {}
        for _, h, ws in toks:
            if not h:
                for v, w in zip([None, *ws], ws, strict=False):
                    uni[w] = uni.get(w, 0) + 1
                    if (v, w) not in bi:
                        kinds[v] = kinds.get(v, 0) + 1
                    bi[v, w] = bi.get((v, w), 0) + 1
                    ctx[v] = ctx.get(v, 0) + 1
        n, size = sum(uni.values()), len(uni)
        p = lambda w: (uni.get(w, 0) + 0.1) / (n + 0.1 * (size + 1))
        want = []
        for d, _, ws in toks:
            s = 0.0
            for v, w in zip([None, *ws], ws, strict=False):
                s += np.log10(max(bi.get((v, w), 0) - 0.75, 0) / ctx[v] + 0.75 * kinds[v] / ctx[v] * p(w) if v in ctx else p(w))
            want.append((d, len(ws), sum(w in uni for w in ws), n, sum(np.log10(p(w)) for w in ws), s))
        want.sort()
        assert [g[:4] for g in got] == [w[:4] for w in want]
        for g, w in zip(got, want, strict=True):
            assert abs(g[4] - w[4]) < 1e-4 * max(1, abs(w[4])) and abs(g[5] - w[5]) < 0.06 + 2e-4 * w[1]
    assert lm_scoring.score(none, held, shards=3).count() == 0
    assert lm_scoring.score(docs, F.lit(True), shards=3).filter("n_known > 0").count() == 0


def test_language_id(spark, none):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    got = language_id.identify(docs, docs.filter(~fold)).join(docs.filter(fold).select("doc_id", "lang"), "doc_id")
    assert got.filter("lang_pred = lang").count() >= 0.95 * got.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (None, "the and of to"), (4, "the " * 60000)], "doc_id long, text string")
    r = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(odd, docs).collect()}
    assert r[1] == r[2] == r[3] == ("und", 0.0) and r[None][0] == r[4][0] == "en" and 0 <= r[4][1] <= 1
    assert language_id.identify(none, docs).count() == 0
    assert {x.lang_pred for x in language_id.identify(odd, none).collect()} == {"und"}


def test_a_text_in_every_language_gets_them_all(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, table = language_id.learn(docs)
    one = {r["lang"]: r["text"] for r in docs.filter("length(text) > 4000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    assert len(langs) == 4 and sorted(one) == langs
    share, size = language_id.mixtures([language_id.raw(" ".join(one[k][:3000] for k in langs[:n])) for n in (1, 2, 3, 4)], table)
    assert size.tolist() == [1, 2, 3, 4] and share[3].min() > 0.15 and share[3].max() < 0.35


def test_toxicity(spark, none):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = toxicity.fit(toxicity.labelled_rows(docs, labels, ~fold))
    scored = model.score(docs.filter(fold)).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").select("score", "toxic", "lang").toPandas()
    rank, y = scored["score"].rank(), scored["toxic"] == 1
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.93 and scored["score"].between(0, 1).all()
    caught = scored[y].groupby("lang")["score"].apply(lambda s: (s >= 0.5).mean())
    assert len(caught) == 4 and caught.min() >= 0.8 and (scored[~y]["score"] < 0.5).mean() >= 0.98
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 200_000), (None, "you idiot moron you are worthless scum " * 5), (3, "x" * 200_000)], "doc_id long, text string")
    r = model.score(odd).collect()
    assert len(r) == 5 and all(0 <= x.score <= 1 for x in r) and max(r, key=lambda x: x.score).doc_id is None
    assert model.score(none).count() == 0
    flat = toxicity.fit(toxicity.labelled_rows(docs, labels.filter("toxic = 0"), ~fold))
    assert {x.score for x in flat.score(odd).collect()} == {0.0}
    assert toxicity.fit(toxicity.labelled_rows(docs, labels.limit(0), ~fold)).score(odd).count() == 5


def test_toxicity_weights_are_cross_fitted(spark):
    """A word that only one part's toxic rows hold has no weight there; copies count once; a row under two labels counts under each."""
    texts = [(k, f"{words(30, 500 + k)} {'grobian' if k % 2 else ''}", k % 2) for k in range(2400)]
    texts += [(10_000 + k, words(30, 7) + " einzelfall", 1) for k in range(200)]  # one text, many copies
    rows = toxicity.grouped(spark.createDataFrame(texts + [(50_000, words(30, 8), 0), (50_000, words(30, 8), 1)], "doc_id long, text string, toxic int"))
    assert rows.filter("doc_id between 10000 and 10199").count() == 1 and rows.filter("doc_id = 50000").count() == 2
    weights = toxicity.learn_weights(rows)
    assert len(weights) == toxicity.PARTS + 1 and all(w["grobian"] > 0 and "einzelfall" not in w for w in weights)
    only = rows.withColumn("text", F.when(F.col("part") == 0, F.col("text")).otherwise(F.replace("text", F.lit("grobian"), F.lit("x"))))
    own = toxicity.learn_weights(only)
    assert "grobian" not in own[0] and "grobian" in own[-1]
    assert toxicity.learn_weights(rows.limit(0)) == [{}] * (toxicity.PARTS + 1)
