"""op3, op6, op7, op8, op9, op10 against brute force, and on odd rows."""

import collections
import math
import re

import numpy as np
import pytest
import xxhash

from llm_fixtures import none, odd, sample  # noqa: F401
from ledgerhawk.llm import attention_lm, langid, licenses, outliers, qda, simhash
from ledgerhawk.llm.common import doc_bucket, keep, read

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# ------------------------------------------------------------------- op3

def brute_fingerprint(text):
    w = SPACE.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=4):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_equals_brute_force(spark, sample):
    docs, rows = sample
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = [brute_fingerprint(t) for _, t in rows]
    assert [got[d].fp & (2**64 - 1) for d, _ in rows] == fps
    groups = collections.defaultdict(list)
    for (d, _), g in zip(rows, brute_components(fps), strict=True):
        groups[g].append(d)
    assert {d: got[d].component_id for d, _ in rows} == {d: min(g) for g in groups.values() for d in g}
    kept = simhash.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())


@pytest.mark.parametrize("chunk", [2, 5, 1000])
def test_links_in_crowded_blocks(spark, chunk):
    """Chains and dense groups of close fingerprints, split into chunks of any size."""
    rng = np.random.default_rng(chunk)
    fps = set()
    for centre in rng.integers(0, 2**63, 4):
        for _ in range(25):
            x = int(centre)
            for b in rng.integers(0, 20, rng.integers(0, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), chunk=chunk)
    assert all((e.a ^ e.b).bit_count() <= 4 and e.a > e.b for e in edges.collect())
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    assert [root.get(x, x) for x in fps] == [fps[i] for i in brute_components(fps)]


def test_simhash_broadcasts_no_growing_table(spark):
    """Spark takes the keys of written fingerprints (35 rows each) for a table as small as the fingerprints' file."""
    docs = keep(spark.createDataFrame([(i, f"w{i} x{i % 7} y z{i % 3}") for i in range(300)], "doc_id long, text string"))
    fps = keep(simhash.with_fingerprint(docs).select("fp").distinct())
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Broadcast" not in plan(simhash.links(fps))
    for df in (simhash.near_duplicates(docs), simhash.one_per_component(docs)):
        assert re.search(r"\w+Join", plan(df))[0] == "SortMergeJoin"  # the topmost


def test_simhash_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.fp == 0} == {0}
    assert next(r for r in got if r.doc_id is None).component_id is None
    kept = simhash.one_per_component(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and ids.count(4) == 1 and None in ids and 8 in ids and 50 not in ids
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_per_component(none).count() == 0


# ------------------------------------------------------------------- op6

def test_language_on_held_out_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    found = {r.doc_id: r for r in langid.identify(docs, langid.train_on(docs)).collect()}
    held = [r for r in docs.collect() if doc_bucket(r.doc_id, 4) == 2]
    right = sum(found[r.doc_id].lang_pred == r.lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(2)
    scores = rng.normal(0, 2, (30, 3))
    offsets = np.array([0, 5, 5, 11, 12])
    codes = rng.integers(0, 30, 12)
    got = langid.viterbi(scores, codes, offsets, 3.0)
    from itertools import product
    for a, b in zip(offsets, offsets[1:], strict=False):
        def total(path, at=codes[a:b]):
            return sum(scores[c, k] for c, k in zip(at, path, strict=True)) \
                - 3.0 * sum(x != y for x, y in zip(path, path[1:], strict=False))
        best = max(map(total, product(range(3), repeat=b - a)))
        assert total(got[a:b].tolist()) == pytest.approx(best)


def test_spans_of_mixed_text_and_scripts(spark):
    en, ru = "the house and the water of the ring ", "дом и вода это кольцо "
    docs = spark.createDataFrame([(i, t * 20, lang) for i, (t, lang) in enumerate(
        [(en, "en"), (ru, "ru"), (en, "en"), (ru, "ru")])], "doc_id long, text string, lang string")
    model = langid.train(docs)
    mixed = spark.createDataFrame([(9, en * 3 + ru), (10, "你好"), (11, "123"), (12, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(mixed, model).collect()}
    assert [(s.lang, s.first_word, s.n_words) for s in got[9].spans] == [("en", 0, 24), ("ru", 24, 5)]
    assert got[9].lang_pred == "en" and got[10].lang_pred in ("en", "ru")
    assert (got[11].lang_pred, got[11].score, got[12].lang_pred) == ("und", 0.0, "und")


def test_text_in_an_unknown_script_or_language_is_no_language(spark):
    en, fr = "the house and the water of the ring ", "la maison et les eaux dans une rue "
    zh, other = "你好 世界 ", "kqxz wvjq zzkx "
    rows = [(i, t * 20, lang) for i, (t, lang) in enumerate([(en, "en"), (fr, "fr")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    probe = [(100, zh * 9), (101, en + zh * 2), (102, en * 3), (103, other * 9), (104, "the house " + zh * 9)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(probe, "doc_id long, text string"), model).collect()}
    assert got[100].score == 0 and got[102].score == 1 and got[102].lang_pred == "en"
    assert got[101].lang_pred == "en" and got[101].score == pytest.approx(28 / 36)
    assert got[104].score < 0.2
    more = docs.unionByName(spark.createDataFrame([(*p, None) for p in probe], docs.schema))
    kept = {r.doc_id for r in langid.with_language(more, 0.4).collect()}
    assert kept & set(range(100, 105)) == {101, 102} and set(range(40)) <= kept


def test_language_odd_rows(odd, none):
    model = langid.train_on(odd)
    got = langid.identify(odd, model).collect()
    assert len(got) == odd.count()
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 3)} == {"und"}
    assert langid.with_language(odd, 0.4).columns == odd.columns
    assert langid.identify(none, langid.train_on(none)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.train_on(none)).collect()} == {"und"}


def test_labelling_a_group_stays_small():
    """A worker's memory while it labels the largest group it joins (two such workers share an executor's memory)."""
    import tracemalloc

    import pyarrow as pa
    text = " ".join(f"word{i % 5000} of text" for i in range(1000))
    rng = np.random.default_rng(4)
    model = langid.Model(["en", "fr"], np.log(rng.random((langid.BUCKETS, 2))),
                         np.ones((len(langid._SCRIPT_NAMES), 2), dtype=bool), np.full(2, -np.inf))
    texts = pa.array([text] * (langid.GROUP_BYTES // len(text)))
    tracemalloc.start()
    langid._label(texts, model, langid.PENALTY)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20


# ------------------------------------------------------------------- op7

def brute_statistics(text):
    text = text or ""
    w = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    grams = list(zip(w, w[1:], w[2:], strict=False))
    count = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_equal_brute_force(sample, odd):
    docs, rows = sample
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in outliers.with_statistics(docs.select("doc_id", "text")).collect()}
    assert got == {d: brute_statistics(t) for d, t in rows}
    for r in outliers.with_statistics(odd.selectExpr("text", "text AS t")).collect():
        assert tuple(r[c] for c in COLUMNS) == brute_statistics(r.t)


def test_outliers_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in outliers.verdicts(read(spark, sf, "documents")).collect()}
    labels = [r for r in read(spark, sf, "labels").collect() if not got[r.doc_id].base_failed]
    good = [got[r.doc_id].kept for r in labels if r.quality == 1]
    bad = [got[r.doc_id].kept for r in labels if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_mcd_resists_a_cluster_of_outliers(spark):
    """A fifth of the rows far away: the estimate is that of the other rows."""
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (1000, 5)) @ np.diag([2, 1, 1, 1, 1])
    x[:200] += 15
    rows = spark.createDataFrame([("c", *map(float, r)) for r in x], ["cell", *outliers.FEATURES])
    m = outliers.mcd(rows).first()
    assert np.abs([m[f"m{i}"] for i in range(5)]).max() < 0.5


def test_rows_are_not_broadcast_to_their_cells(spark):
    """Spark expects a join to have the product of its sides' sizes, so the few cells passed for more than the rows."""
    rows = keep(spark.range(3000).selectExpr("concat('l', id % 7) AS lang", "concat('s', id % 5) AS source", "rand(1) AS x"))
    got = outliers.with_cells(rows)
    side = re.search(r"BroadcastHashJoin .*?(Build\w+)", got._jdf.queryExecution().executedPlan().toString())
    assert side is None or side[1] == "BuildRight"
    assert {(r.lang, r.source): r.cell for r in got.collect()} == {
        (f"l{i % 7}", f"s{i % 5}"): f'cell {{"lang":"l{i % 7}","source":"s{i % 5}"}}' for i in range(35)}
    assert got.count() == 3000


def test_outliers_odd_rows(odd, none):
    got = outliers.verdicts(odd).collect()
    assert len(got) == odd.count()
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (0, 1, 2, 3, 4))
    assert outliers.without_outliers(odd).columns == odd.columns
    assert outliers.verdicts(none).count() == 0 and outliers.without_outliers(none).count() == 0


# ------------------------------------------------------------------- op8

def test_lm_base_scores_and_counts(spark, sample):
    docs, rows = sample
    got = {r.doc_id: r for r in attention_lm.score(docs).collect()}
    words = {d: SPACE.findall(lower(t)) for d, t in rows}
    train = [d for d, _ in rows if doc_bucket(d, 10)]
    c = collections.Counter(w for d in train for w in words[d])
    n, v = sum(c.values()) + len(train), len(c) + 1
    for d, _ in rows:
        counts = [c[w] for w in words[d]] + [len(train)]
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in counts)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            doc_bucket(d, 10) == 0, len(counts), sum(x > 0 for x in counts), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0


def toy_model():
    rng = np.random.default_rng(4)
    seqs = [np.cumsum(rng.integers(0, 2, 70)) % 40 for _ in range(60)]
    ids = [s.astype("<u2").tobytes() for s in seqs]
    flat, before, _ = attention_lm._closed(ids, 40)
    t = attention_lm.Tables.of_ids(np.bincount(flat, minlength=41), 16)
    after, then = np.zeros((t.seen, 16)), np.zeros((16, t.seen + 1))
    np.add.at(after, (t.column[before], t.of[flat]), 1)
    np.add.at(then, (t.of[before], t.column[flat]), 1)
    t.fill(after, then)
    return t, attention_lm.Attention(t.skip), ids


def test_lm_is_a_probability(spark):
    """Over all next ids, the probabilities after any context add up to one."""
    t, net, _ = toy_model()
    model = attention_lm.Model(t, net)
    for context in ([], [3], [5, 6, 7, 7, 8] * 8, list(range(32))):
        total = 0.0
        for after in [[i] for i in range(40)] + [[]]:  # every id, or the end
            text = np.array([*context, *after], dtype="<u2").tobytes()
            total += math.exp(model.symbol_logs(*attention_lm._closed([text], 40))[len(context)])
        assert total == pytest.approx(1.0, abs=1e-4)
    assert model.score([]).tolist() == []


def test_lm_gradient_is_the_slope():
    t, net, ids = toy_model()
    flat, before, bounds = attention_lm._closed(ids[:4], 40)
    first, text = attention_lm.windows(bounds)
    w, at, real = attention_lm.window_rows(t.of[before], bounds, first, text)
    rows, y = t.row[before][at], t.of[flat][at]

    def loss(p):
        return -np.where(real, attention_lm.Attention(t.skip, p).log_class(w, rows, y), 0).sum() / real.sum()
    net = attention_lm.Attention(t.skip, net.p.astype(np.float64))
    g = net.gradient(w, rows, y, real.astype(float))
    rng = np.random.default_rng(0)
    for i in rng.choice(len(net.p), 25, replace=False):
        up, down = net.p.copy(), net.p.copy()
        up[i] += 1e-4
        down[i] -= 1e-4
        assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(g[i], abs=2e-4)


def test_lm_learns_from_every_window_once():
    for sizes in ([1] * 40, [5, 16, 17, 300, 1, 0, 900]):
        bounds = np.append(0, np.cumsum(sizes))
        picked = [attention_lm.turn_windows(bounds, turn) for turn in range(attention_lm.ROUNDS)]
        assert sorted(np.concatenate(picked).tolist()) == list(range(sum(-(-n // attention_lm.HOP) for n in sizes)))


def test_lm_words_of_a_text_take_little_room(sample):
    """Word codes are stored so that Spark's compression finds their upper bytes, and come back unchanged."""
    import pyarrow as pa

    from ledgerhawk.llm.subword import default_path
    docs, rows = sample
    written = attention_lm.blocks(docs.selectExpr("doc_id", "text", "true AS train"), default_path()).toPandas()
    word = {(r.block, r.code): r.word for r in written[written.code.notna()].itertuples()}
    texts, stored, plain, lz4 = dict(rows), b"", 0, pa.Codec("lz4_raw")
    for r in written[written.row.notna()].itertuples():
        stored += r.words
        got = attention_lm.unpacked(r.words)
        plain += got.nbytes
        assert [word[r.block, c] for c in got.tolist()] == SPACE.findall(lower(texts[r.doc_id]))
    assert len(lz4.compress(stored)) < 0.6 * plain
    for codes in ([], [0], [1, 2**32 - 1, 70_000]):
        assert attention_lm.unpacked(attention_lm.packed(np.array(codes, dtype=np.int64))).tolist() == codes


def test_lm_words_come_in_one_row_per_slice(spark, sample):
    """A block's words take a row per slice, not per word, and are counted over all blocks exactly."""
    import pyarrow as pa

    from ledgerhawk.llm.subword import default_path
    docs, rows = sample
    texts = docs.selectExpr("doc_id", "text", "doc_id % 3 > 0 AS train").repartition(3)
    written = attention_lm.blocks(texts, default_path(), slices=8).toPandas()
    part = written[written.slice.notna()]
    assert not part.duplicated(["block", "slice"]).any() and part.slice.between(0, 7).all()
    words = {(r.block, c): w for r in part.itertuples()
             for c, w in zip(np.frombuffer(r.codes, "<u4").tolist(), r.spelled.split("\n"), strict=True)}
    c = collections.Counter(w for d, t in rows if d % 3 for w in SPACE.findall(lower(t)))
    got, n, v = {}, 0, 0
    for _, rest in part.groupby("slice"):
        counted = attention_lm._count(pa.Table.from_pandas(
            rest[["block", "size", "spelled", "codes", "n"]].astype({"size": int}), preserve_index=False)).to_pylist()
        n, v = n + sum(r["n"] for r in counted), v + sum(r["v"] for r in counted)
        for r in counted:
            got |= {(r["block"], x): k for x, k in zip(np.frombuffer(r["codes"], "<u4").tolist(),
                                                       np.frombuffer(r["c"], "<i8").tolist(), strict=True)}
    assert got == {k: c[w] for k, w in words.items()}
    assert (n, v) == (sum(c.values()), len(c))


def toy_windows(t, ids):
    flat, before, bounds = attention_lm._closed(ids, 40)
    first, text = attention_lm.windows(bounds)
    return flat, before, bounds, first, text


def test_lm_batches_laid_out_together_give_each_its_gradient():
    t, net, ids = toy_model()
    flat, before, bounds, first, text = toy_windows(t, ids)
    rows, after = t.row[before], t.of[flat]
    some = np.random.default_rng(1).permutation(len(first))[:180].reshape(3, 60)
    arrays = list(attention_lm.step_arrays(rows, after, bounds, first[some], text[some]))
    steps = attention_lm.Steps(net, *arrays)
    assert max(np.bincount(steps.there[0].reshape(-1))) > attention_lm.TURNS  # sums by turns and by row
    for k in range(3):
        i, g = net.gradient_rows(steps, k)
        assert len(set(i.tolist())) == len(i)
        got = np.zeros_like(net.p)
        got.reshape(-1, g.shape[1])[i] = g
        alone = net.gradient(*(x[k] for x in arrays))
        assert got == pytest.approx(alone, abs=1e-6) and np.abs(got).max() > 1e-3


def test_lm_adam_steps_touch_their_rows_alone():
    t, net, ids = toy_model()
    flat, before, bounds, first, text = toy_windows(t, ids)
    rows, after = t.row[before], t.of[flat]
    adam = attention_lm.Adam(attention_lm.Attention(t.skip, net.p.copy()), np.float32(0.01))
    plain = attention_lm.Attention(t.skip, net.p.copy())
    p = plain.p.reshape(adam.p.shape)
    m, v, taken = np.zeros_like(p), np.zeros_like(p), np.zeros((len(p), 1), dtype=np.float32)
    for step, k in enumerate(range(0, 40, 8), 1):
        some = np.arange(k, k + 8)[None]
        steps = attention_lm.Steps(adam.net, *attention_lm.step_arrays(rows, after, bounds, first[some], text[some]))
        i, g = plain.gradient_rows(steps, 0)
        adam.learn(steps)
        taken[i] += 1
        m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
        p[i] -= 0.01 / (1 + step / 500) * (m[i] / (1 - 0.9 ** taken[i])) / (np.sqrt(v[i] / (1 - 0.99 ** taken[i])) + 1e-6)
        assert np.abs(adam.p - p).max() < 1e-4
    assert (adam.taken == taken[:, 0]).all() and 0 < (adam.taken == 0).sum() < len(p)
    untouched = adam.taken == 0
    assert (adam.p[untouched] == net.p.reshape(p.shape)[untouched]).all()


def test_lm_consecutive_windows_score_as_single_ones():
    """Texts of no, one, few and very many windows, scored in a run, against every window by itself."""
    t, net, _ = toy_model()
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 40, n).astype("<u2").tobytes() for n in (0, 1, 15, 16, 17, 31, 32, 9000, 5, 300)]
    flat, before, bounds, first, text = toy_windows(t, ids)
    got = attention_lm.Model(t, net).symbol_logs(flat, before, bounds)
    rows, want = t.row[before], np.log(t.within(t.of[before], flat))
    for k in range(len(first)):
        w, at, real = attention_lm.window_rows(rows, bounds, first[k:k + 1], text[k:k + 1])
        want[at[real]] += net.log_class(w, rows[at], t.of[flat][at])[real]
    assert got == pytest.approx(want, rel=1e-4, abs=1e-4)
    net.p *= 400  # exponents beyond the limit: these are clipped
    assert not attention_lm.Attention(t.skip, net.p).calm and attention_lm.Attention(t.skip, net.p / 400).calm


def test_lm_attention_sees_ids_not_classes():
    """Two contexts that differ in one id, not in its class, beyond the id directly before."""
    t, net, _ = toy_model()
    a, b = np.flatnonzero(t.of == np.bincount(t.of).argmax())[:2].tolist()
    model, logs = attention_lm.Model(t, net), []
    for x in (a, b):
        text = np.array([3, x, 5, 6, 7], dtype="<u2").tobytes()
        logs.append(model.symbol_logs(*attention_lm._closed([text], 40))[4])
    assert t.of[a] == t.of[b] and logs[0] != logs[1]


def test_lm_odd_rows(odd, none):
    got = attention_lm.score(odd).collect()
    assert len(got) == odd.count() and all(r.score < 0 and r.n_tokens >= 1 for r in got)
    assert len({(r.score, r.base_score) for r in got if r.doc_id == 4}) == 1
    assert attention_lm.score(none).count() == 0


# ------------------------------------------------------------------- op9

def test_license_base_equals_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    places = 0
    for r in docs.collect():
        w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r.text))
        hits = sorted((i, label) for p, label in licenses.PHRASES for i in range(len(w))
                      if w[i:i + len(p.split())] == p.split())
        g = got[r.doc_id]
        assert (g.n_words, g.n_base) == (len(w), len(hits))
        assert (g.first_word, g.last_word) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
        assert g.base_labels == ",".join(sorted({x for _, x in hits}))
        assert set(filter(None, g.base_labels.split(","))) <= set(filter(None, g.labels.split(",")))
        places += len(hits)
    assert places


@pytest.mark.parametrize("k", range(7))
def test_every_notice_with_few_errors_is_found(k):
    rng = np.random.default_rng(k)
    find = licenses.scanner()
    for label, notice, errors in licenses.NOTICES:
        text = list(notice)
        for _ in range(min(k, errors)):
            inside = [i for i in range(1, len(text) - 1) if " " not in text[i - 1:i + 2]]  # a lost space is two edits
            i, kind = int(rng.choice(inside)), rng.integers(0, 3)
            if kind == 0:
                del text[i]
            elif kind == 1:
                text.insert(i, "q")
            else:
                text[i] = "q"
        around = licenses.normalise("some words before. " + "".join(text) + " and after it")
        assert label in {s["label"] for s in find.spans(around)}, (notice, "".join(text))


def ends_within(text, notice, errors):
    """Brute force: runs of ends at which some part of the text is within ``errors`` edits of the notice, with the fewest."""
    row, runs, last = list(range(len(notice) + 1)), [], None
    for end, c in enumerate(text, 1):
        new = [0]
        for i, x in enumerate(notice, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        if row[-1] <= errors:
            if last == end - 1:
                runs[-1] = min(runs[-1], row[-1])
            else:
                runs.append(row[-1])
            last = end
    return runs


@pytest.mark.parametrize("k", range(4))
def test_adjacent_notices_are_spans_of_their_own(k):
    rng = np.random.default_rng(100 + k)
    find = licenses.scanner()
    for n, (_, notice, errors) in enumerate(licenses.NOTICES):
        parts = []
        for _ in range(4):
            text = list(notice)
            for _ in range(int(rng.integers(0, errors + 1))):
                i = int(rng.integers(1, len(text) - 1))
                text[i:i + 1] = [[], ["q"], ["q", text[i]]][rng.integers(0, 3)]
            parts += ["".join(text), *["filler"] * int(rng.integers(0, 2))]
        text = licenses.normalise(" ".join(parts))
        mine = next((m for i, m in find.matches(text) if i == n), [])
        got = [(a, wrong) for wrong, a, _ in licenses.apart(mine)]
        assert [wrong for _, wrong in sorted(got)] == ends_within(text, notice, errors), (notice, text)


def test_license_spans_of_two_notices_and_linear_time():
    import time

    find = licenses.scanner()
    spans = find.spans(licenses.normalise("released under the mit licence released under the mit license"))
    assert [(s["first_word"], s["n_words"], s["errors"]) for s in spans if s["label"] == "mit"] == [(0, 5, 1), (5, 5, 0)]

    def seconds(n):
        text = licenses.normalise("x apache license version 2 0 " * n)
        start = time.process_time()
        assert len(find.base(text)) == n and len(find.spans(text)) >= 0
        return time.process_time() - start
    seconds(1000)
    assert seconds(40_000) < 4 * max(seconds(20_000), 0.05)


def test_license_odd_rows(odd, none):
    got = licenses.scan(odd).collect()
    assert len(got) == odd.count() and all(r.labels == "" and r.score == 0 for r in got)
    assert licenses.scan(none).count() == 0


# ------------------------------------------------------------------- op10

def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in qda.classify(read(spark, sf, "documents"), read(spark, sf, "labels")).collect()}
    held = [(got[r.doc_id], r.quality) for r in read(spark, sf, "labels").collect() if got[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.98
    assert all(r.held_out == (doc_bucket(d, 4) == 2) and 0 <= r.score <= 1 for d, r in got.items())


def brute_log_statistics(text):
    """The statistics of a text from their names, character by character."""
    raw = (text or "").encode("utf-8", "replace").decode("latin-1")
    w = [x for x in re.split("[\t\n\x0b\x0c\r ]+", raw) if x]
    n = max(len(w), 1)
    lines = [x for x in raw.split("\n") if x.strip(" \t\x0b\x0c\r")]

    def share(pattern):
        return len(re.findall(pattern, raw))
    size = max(len(raw), 1)
    return [math.log(len(w) + 1), math.log((sum(len(x) for x in w) + 1) / n), math.log(1 + 100 * share("[#*$%&|<>]") / n),
            10 * share("[A-Z]") / size, math.log(1 + 100 * share(r"[!?;:=+~^_/\\]") / n),
            math.log(1 + 100 * sum(x in lines[:i] for i, x in enumerate(lines)) / n),
            math.log((len(set(w)) + 1) / (n ** 0.8 + 1)),
            math.log(1 + 20 * max([w.count(x) for x in set(w)], default=0) / n),
            math.log(1 + 100 * sum(w[i] == w[i - 1] for i in range(1, len(w))) / n),
            math.log(1 + 1000 * share("[0-9]") / size)]


def test_quality_equals_brute_force(spark, odd):
    docs = read(spark, SF, "documents").select("doc_id", "text").unionByName(
        odd.selectExpr("doc_id + 10000000 AS doc_id", "text"))
    labels = read(spark, SF, "labels").select("doc_id", "quality")
    rows = [(r.doc_id, np.array(brute_log_statistics(r.text))) for r in docs.collect()]
    by_id = dict(rows)
    train = {c: np.array([by_id[r.doc_id] for r in labels.collect()
                          if r.quality == c and r.doc_id in by_id and doc_bucket(r.doc_id, 4) != 2]) for c in (0, 1)}
    n = {c: len(x) for c, x in train.items()}
    assert min(n.values()) > 2
    raw = {c: np.cov(x.T, bias=True) for c, x in train.items()}
    pooled = (n[0] * raw[0] + n[1] * raw[1]) / (n[0] + n[1])
    share = (n[1] + 1) / (n[0] + n[1] + 2)

    def density(c, x):
        cov = 0.8 * raw[c] + 0.1 * pooled + 0.1 * np.diag(np.diag(raw[c])) + qda.FLOOR * np.eye(len(x))
        d = x - train[c].mean(axis=0)
        return -0.5 * (d @ np.linalg.inv(cov) @ d + np.linalg.slogdet(cov)[1])

    def score(x):
        odds = density(1, x) - density(0, x) + math.log(share / (1 - share))
        return 1 / (1 + math.exp(-min(max(odds, -500), 500)))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.score, r.predicted) for r in qda.classify(docs, labels).collect()))
    want = sorted((d is None, d or 0, score(x)) for d, x in rows)
    assert [g[:2] for g in got] == [x[:2] for x in want]
    assert np.allclose([g[2] for g in got], [x[2] for x in want], atol=1e-7)
    assert all(p == int(s >= 0.7) for _, _, s, p in got)


def test_quality_without_labels_and_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)] + [(None, 1, 0), (3, None, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = qda.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in qda.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert qda.classify(none, labels).count() == 0
