"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import numpy as np
import pytest

import corpus_pipeline
from tidalrec.llm import (bestfit, byte_cnn, components, importance, lattice, merge_dropout, notices, reply_trees,
                          rule_ledger, tensor_minhash, wrappers)
from tidalrec.llm.common import Scratch

LONG = " ".join(f"word{i} of" for i in range(30_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, t string, n int"
ROWS = [(1, "the cat sat on the mat today", "en", "s", 1, "x", "y", "z", 0),
        (1, "the cat sat on the mat today", "en", "s", 1, "x", "y", "z", 0),
        (2, None, None, None, None, None, None, None, None), (3, "", "en", "s", 0, "", "", "", 1),
        (4, " \t\n ", "en", "s", 0, "", "", "", 1), (None, "no id at all in this row", "en", "s", 1, "", "", "", 1),
        (5, LONG, "en", "s", 1, "", "", "", 1), (6, LONG + " tail", "en", "s", 1, "", "", "", 1),
        (7, "the cat sat on the mat today", "fr", "s", 1, "", "", "", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_ledger_cases(spark, docs, none):
    assert rule_ledger.ledger(none).count() == 0
    led = rule_ledger.ledger(docs).collect()
    assert len(led) == len(ROWS)
    blank = [r for r in led if r.doc_id in (2, 3, 4)]
    assert all(r.n_words == 0 and r.fail_bits & rule_ledger.BIT["too_few_words"] for r in blank)
    assert {r.n_words for r in led if r.doc_id == 5} == {60_000}
    ab = {r.rule: r for r in rule_ledger.ablations(rule_ledger.ledger(docs), rule_ledger.V1).collect()}
    assert ab["too_few_words"].n_failed == 7 and ab["too_few_words"].n_only <= 7
    assert rule_ledger.keep(docs).columns == docs.columns


def test_near_dup_cases(spark, docs, none):
    assert tensor_minhash.near_duplicates(none).count() == 0
    got = tensor_minhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.component_id) for r in got}
    assert {(1, 1), (7, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (None, None)} == by
    assert [r.n_shingles for r in got if r.doc_id in (2, 3, 4)] == [0, 0, 0]


def test_links_within_mixed_buckets_are_found(spark):
    """A chain whose ends are not alike, in one bucket whose least id links with nothing."""
    members = spark.createDataFrame([(1, i, True) for i in (1, 5, 6, 7, 9)], "key long, id long, home boolean")
    alike = {(5, 6), (6, 7)}
    verify = lambda pairs: pairs.where(" or ".join(f"(a = {a} and b = {b})" for a, b in alike))
    from pyspark.sql import functions as F
    out = components.link_buckets(members, verify, lambda x, y: F.lit(True), Scratch(spark, "test"))
    assert {(r.id, r.component) for r in out.collect()} == {(5, 5), (6, 5), (7, 5)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500)], "a long, b long")
    out = {r.id: r.component for r in components.connected_components(edges, Scratch(spark, "test")).collect()}
    assert out == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}


def test_resampling_cases(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert importance.resample(none, labels).count() == 0
    got = importance.resample(docs, labels).collect()
    assert len(got) == len(ROWS)
    assert not any(r.kept for r in got if r.doc_id in (2, 3, 4))
    unlabelled = importance.resample(docs, labels.limit(0)).collect()
    assert sum(r.kept for r in unlabelled) == 6
    three = importance.resample(docs, labels, importance.Resampling(k=2)).collect()
    assert 2 <= sum(r.kept for r in three) <= 3   # equal rows tie


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=500), [3.0] * 20]).tolist()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 7, 21, 300, 520):
        assert importance.kth_largest(df, "x", k, bins=16) == sorted(values)[-k]


def test_packing_cases(spark, docs, none):
    assert bestfit.pack(none).count() == 0
    got = bestfit.pack(docs).collect()
    assert sum(r.length == 1 for r in got if r.doc_id in (2, 3)) == 2
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}


def test_plan_places_everything():
    rng = np.random.default_rng(0)
    for _ in range(50):
        counts = {int(s): int(rng.integers(1, 40)) for s in rng.choice(np.arange(1, 101), 30, replace=False)}
        kinds = bestfit.plan(dict(counts), 100)
        placed = {}
        for inside, n in kinds:
            assert sum(inside) <= 100 and sum(3 * s > 100 for s in inside) <= 2
            for s in inside:
                placed[s] = placed.get(s, 0) + n
        assert placed == counts
        assert {(s, c) for s, c in counts.items()} == {
            (s, sum(x[2] for x in bestfit.segments(kinds) if x[0] == s)) for s in counts}


def test_notice_cases(spark, docs, none):
    assert notices.search(none).count() == 0
    assert [r.n_words for r in notices.search(docs).collect() if r.doc_id in (2, 3, 4)] == [0, 0, 0]
    finder = notices.Finder(notices.Search())
    n, base, found = finder.find("It is released undr the M.I.T? no: Released  under the MIT\nLicence, v2")
    assert n == 15 and not base and [f[0] for f in found] == ["mit"] and found[0][3] == 1
    assert finder.find("MIT License. mit-license")[1] == [(0, "mit"), (2, "mit")]


def test_notices_before_a_better_match_are_found():
    finder = notices.Finder(notices.Search())
    worse, right = "licensed under the apache licence version", "licensed under the apache license version"
    for text in (f"{worse} {right}", f"{right} {worse}", f"{worse} {worse} {right} {worse}"):
        at = [k for k in range(len(text)) if text.startswith((worse, right), k)]
        spans = [(f[1] - 1, f[3]) for f in finder.find(text)[2] if f[0] == "apache"]
        assert [s for s, _ in spans] == at and [e for _, e in spans] == [int(text.startswith(worse, k)) for k in at]


def test_dropout_codec(spark, none, docs):
    import public_tokenizers
    import sentencepiece
    assert merge_dropout.encode(none).count() == 0
    assert merge_dropout.decode(merge_dropout.encode(docs)).count() == len(ROWS)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["", " ", "  a  b\nc\t d ", "Grüße, ﬁne ①", LONG[:3000], "x" * 300, "\0 nul", "été\r\n" * 5]
    plain, varied = merge_dropout.Codec(merge_dropout.Dropout(rate=0.0)), merge_dropout.Codec(merge_dropout.Dropout(rate=0.3))
    for t in texts:
        if "\0" not in t:
            assert plain.encode(t, 1).tolist() == sp.encode(t)
        assert varied.decode(varied.encode(t, 3)) == t
    assert varied.decode(varied.encode("▁a ▁\0▁ b", 3)) == "▁a ▁\0▁ b"
    unit = "▁international" * 1
    assert len({tuple(varied.segment(unit, v)) for v in range(40)}) > 5
    for v in range(20):  # row and heap agendas agree
        for u in (unit, "a", "▁", "▁dasenergever,", "été" * 9):
            ids = varied._segment_rows(varied._char_id[[[ord(c) for c in u]]], np.array([varied._key(u, v)]))
            assert ids[ids >= 0].astype("<u4").tobytes() == varied._unit_ids(u, v)
    keys = range(7, 7 + len(texts))
    for t, k, ids in zip(texts, keys, varied.encode_all(texts, keys), strict=True):  # together or alone
        assert ids.tolist() == merge_dropout.Codec(merge_dropout.Dropout(rate=0.3)).encode(t, k).tolist()
    small = merge_dropout.Codec(merge_dropout.Dropout(rate=0.3, cache_units=1))
    assert [small.encode(t, 5).tolist() for t in texts] == [varied.encode(t, 5).tolist() for t in texts]


def test_dropout_draws_for_each_occurrence():
    """A word of m merges keeps them all in 0.9^m of its occurrences, whatever the worker has seen."""
    codec = merge_dropout.Codec(merge_dropout.Dropout())
    plain = merge_dropout.Codec(merge_dropout.Dropout(rate=0.0))
    for word in ("the", "international", "Grüße", "①the"):
        base, ends = plain._unit_ids("▁" + word, 0), []
        whole = codec._cut(" ".join([word] * 8_000), 5)
        ends = [codec._encode_group([([u], d[None])])[0].tobytes() for u, d in zip(*whole)]
        again = merge_dropout.Codec(merge_dropout.Dropout())._encode_group([whole])[0].tobytes()
        assert b"".join(ends) == again                          # together or alone, whatever the worker has seen
        assert ends[:500] == [codec._unit_ids(u, int(d)) for u, d in zip(whole[0][:500], whole[1])]
        (_, _, (turns,), _), = plain._segment_all(["▁" + word], None)
        (_, drawn, _, last), = codec._segment_all(["▁" + word] * (len(ends) - 1), whole[1][1:])
        assert drawn == ends[1:]
        assert abs(np.mean(last < 0) - 0.9**turns) < 0.02
        assert {x for x, skipped in zip(drawn, last) if skipped < 0} == {base}
        assert len(set(drawn)) > (3 if "①" in word else 4)


def test_dropout_tree_keeps_what_is_used():
    """A full tree goes on with its most used half (it was emptied, and words met all the time segmented anew)."""
    import random
    rnd = random.Random(5)
    often = [f" common{'abcdefghij'[k]}" for k in range(10)]
    texts = ["".join([*often * 20, *(" r" + "".join(rnd.choices("abcdefgh", k=9)) for _ in range(120))])
             for _ in range(40)]
    small = merge_dropout.Codec(merge_dropout.Dropout(cache_units=600))
    whole = merge_dropout.Codec(merge_dropout.Dropout(cache_units=10**9))
    done, segment_all = [], small._segment_all

    def counted(units, keys):
        done.extend(units if keys is None else [])
        return segment_all(units, keys)

    small._segment_all = counted
    for k, text in enumerate(texts):
        assert small.encode(text, k).tolist() == whole.encode(text, k).tolist()
        for w, i in small._child.items():                       # a node's parent is kept and used no less
            assert small._uses[w >> 16] >= small._uses[i]
    assert max(done.count("▁" + word[1:]) for word in often) == 1
    assert len(done) > 4_000


def test_dropout_rows_of_all_widths_agree_with_the_heap():
    codec = merge_dropout.Codec(merge_dropout.Dropout(rate=0.3))
    units = [("▁international①éxyz" * 3)[:n] for n in range(1, 49)] * 3 + ["①", "▁▁▁", "a" * 48, "①②③"]
    keys = np.arange(len(units), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seen = set()
    for some, blobs, _, _ in codec._segment_all(units, keys):
        for at, blob in zip(some, blobs, strict=True):
            assert blob == codec._unit_ids(units[at], int(keys[at]))
        seen.update(some)
    assert seen == set(range(len(units)))


def test_dropout_decodes_many_texts_at_once(spark):
    """A group of texts is decoded in one step; null ids, no ids and ids that stand for no bytes as before."""
    codec = merge_dropout.Codec(merge_dropout.Dropout(rate=0.3))
    texts = ["", "a", " ", "Grüße ① \n\n x", "", "\0▁ nul ▁", "  two  spaces\t\r", "été" * 50]
    ids = codec.encode_all(texts, range(len(texts)))
    got = codec.decode_all(np.concatenate(ids), np.array(list(map(len, ids))))
    assert got.to_pylist() == texts
    rows = [(k, x.tolist()) for k, x in enumerate(ids)] + [(90, None), (91, [])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    assert {r.doc_id: r.text for r in merge_dropout.decode(frame).collect()} == {
        **dict(enumerate(texts)), 90: None, 91: ""}
    for bad in (-1, 10**6, 1):                                   # 1: a control id
        with pytest.raises(KeyError):
            codec.decode(np.array([bad]))
    with pytest.raises(ValueError):
        codec.decode_all(np.array([codec._bytes[0x20], codec._bytes[0xC3]]), np.array([2]))


def test_language_cases(spark, docs, none):
    p = byte_cnn.ByteCnn(steps=5)
    w, langs = byte_cnn.fit(docs.select("text", "lang"), p)
    assert langs == ["en", "fr"]
    assert byte_cnn.classify(none.select("doc_id", "text"), w, langs, p).count() == 0
    got = byte_cnn.classify(docs.select("doc_id", "text"), w, langs, p).collect()
    assert [(r.lang_pred, r.score) for r in got if r.doc_id in (2, 3, 4)] == [("und", 0.0)] * 3
    w, langs = byte_cnn.fit(none.select("text", "lang"), p)
    assert {r.lang_pred for r in byte_cnn.classify(docs.select("doc_id", "text"), w, langs, p).collect()} == {"und"}


def test_training_windows_come_from_the_whole_text():
    p = byte_cnn.ByteCnn(window=16, train_windows=4)
    text = b"".join(b"%016d" % i for i in range(1000)) + b"short end"
    got = [int(bytes(w)) for w in byte_cnn.picked_windows(text, p)]
    assert len(got) == 4 and got == sorted(got) and got[-1] > 100
    assert byte_cnn.picked_windows(b"ab", p).tolist() == [[97, 98] + [0] * 14]


def test_language_score_is_a_mean_over_windows(spark):
    p = byte_cnn.ByteCnn(steps=60, window=32)
    rows = [(f"the cat {i} and the dog went to the house with a hat", "en") for i in range(20)]
    rows += [(f"le chat {i} est dans la maison avec un chien et du lait", "fr") for i in range(20)]
    w, langs = byte_cnn.fit(spark.createDataFrame(rows, "text string, lang string"), p)
    mixed = " ".join([rows[0][0]] * 60 + [rows[30][0]] * 40)
    r, = byte_cnn.classify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), w, langs, p).collect()
    assert r.lang_pred == "en" and 0.4 < r.score < 0.8


def test_network_gradients():
    p = byte_cnn.ByteCnn(window=12, embed=3, filters=4, widths=(2, 3))
    rng = np.random.default_rng(3)
    w = {k: v.astype(np.float64) for k, v in byte_cnn.init(p, 3).items()}
    x, y = rng.integers(1, 256, (5, 12)), rng.integers(0, 3, 5)
    logp, state = byte_cnn.forward(w, p, x)
    grads = byte_cnn.backward(w, p, x, y, logp, state)
    loss = lambda: -byte_cnn.forward(w, p, x)[0][np.arange(5), y].mean()
    for name in ("W", "c", "K2", "b3", "E"):
        g = grads[name]
        for at in map(tuple, np.argwhere(np.abs(g) > 1e-3)[:4]):
            old = w[name][at]
            w[name][at] = old + 1e-6
            up = loss()
            w[name][at] = old - 1e-6
            down = loss()
            w[name][at] = old
            assert abs((up - down) / 2e-6 - g[at]) < 1e-4


def test_vector_cases(spark):
    v = [1.0, 0.0, 2.0]
    rows = [(1, v, "a"), (2, v, "a"), (3, [2.0, 0.0, 4.0], "a"), (4, None, "a"), (5, [0.0] * 3, "a"),
            (6, [float("nan"), 1.0, 1.0], "a"), (7, [None, 1.0, 1.0], "a"), (8, [1.0, 0.0], "a"), (9, [], "a"),
            (10, [1e300, 0.0, 2e300], "a"), (None, [5.0, 5.0, -9.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string")
    assert lattice.near_vectors(df.limit(0)).count() == 0
    got = {r.vec_id: r for r in lattice.near_vectors(df).collect()}
    assert [(got[i].n_links, got[i].component_id) for i in (1, 2, 3, 10)] == [(3, 1)] * 4
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (4, 5, 6, 7, 8, 9))


def test_lattice_points_are_nearest():
    x = np.random.default_rng(2).normal(size=(500, 8)) * 3
    y = lattice.nearest_e8(x)
    assert ((2 * y == np.rint(2 * y)).all() and (y.sum(axis=1) % 2 == 0).all())
    d = ((x - y) ** 2).sum(axis=1)
    for v in lattice.minimal_vectors():
        assert (d <= ((x - y - v) ** 2).sum(axis=1) + 1e-9).all()


def test_counts_in_blocks_equal_whole(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.15).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in lattice.near_vectors(df, lattice.LatticeLinks(block=16)).collect()}
    assert [got[i] for i in range(120)] == want.tolist()


def test_reply_tree_branches(spark):
    rows = [("t", "a", None, "user", "hi", 1.0), ("t", "b", "a", "assistant", "one", 1.0),
            ("t", "c", "a", "assistant", "two </s>", 5.0), ("t", "d", "c", "user", None, 0.5),
            ("t", "e", "b", "user", "x", 2.0), ("u", "f", "gone", None, "<|im_end|>\n", None),
            ("w", "p", "q", "user", "cycle", 1.0), ("w", "q", "p", "user", "cycle", 1.0)]
    m = spark.createDataFrame(rows, "tree string, node string, parent string, role string, text string, score double")
    assert reply_trees.paths(m.limit(0)).count() == 0
    best = reply_trees.format_paths(reply_trees.paths(m, 2), m).collect()
    assert {(r.tree, r.branch, r.leaf) for r in best} == {("t", 1, "d"), ("t", 2, "e"), ("u", 1, "f")}
    for r in best:
        for s in r.loss_spans:
            assert r.formatted[s.start:s.start + s.length] in ("one", "two <\\/s>")
    digest = {r.conv_id: r for r in reply_trees.digest(spark.createDataFrame([x for x in best if x.branch == 1])).collect()}
    assert digest["t"].n_turns == 3 and digest["t"].loss_chars == len("two </s>") and digest["u"].n_turns == 1


def test_page_cases(spark):
    pages = [(1, "http://a.org/x", None), (2, None, ""), (3, "http://a.org/y", "<p>a &lt; b&nbsp;c<p>x<br>y <script>'</p>'</script>"),
             (4, "u", "<article><h1>T</h1><aside>no</aside><div class='user-comments'>no</div><p>yes &#233;</p></article><form>no</form>"),
             (5, "u", "<article><p>cut of <b"), (5, "u", "<article><p>cut of <b"), (6, "u", "plain < text"), (7, "u", "<!-- <p>no</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert wrappers.main_text(df.limit(0)).count() == 0
    got = [(r.page_id, r.text) for r in wrappers.main_text(df).collect()]
    assert len(got) == len(pages)
    assert {(1, ""), (2, ""), (3, "a < b c\nx y"), (4, "T\nyes é"), (5, "cut of"), (7, "")} <= set(got)


def test_wrappers_without_an_article(spark):
    menu = "".join(f"<li><a href='{i}'>entry {i}</a></li>" for i in range(4))
    page = lambda k: (k, f"http://h.net/{k}", f"<body><ul>{menu}</ul><div id=x><p>Same words on all pages</p>"
                      + "".join(f"<p>body {k} line {j} with some words</p>" for j in range(k % 3 + 1)) + "</div></body>")
    df = spark.createDataFrame([page(k) for k in range(9)], "page_id long, url string, html string")
    for r in wrappers.main_text(df).collect():
        assert f"body {r.page_id} line 0" in r.text and "entry" not in r.text


def test_wrapper_algebra():
    s = lambda x: wrappers.parse(x)
    assert wrappers.show(wrappers.fold(s("a b c b c d d"))) == "a (b c)+ (d)+"
    assert wrappers.show(wrappers.align(s("a b c"), s("a c d"))) == "a (b)? c (d)?"
    assert wrappers.show(wrappers.align(s("a (b)+ c"), s("a b c"))) == "a (b)+ c"
    for x in ("a (b c)+ d", "((a)+)? b"):
        assert wrappers.show(s(x)) == x


def test_stages_on_odd_tables(spark, docs, none):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0, name
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
    assert corpus_pipeline.near_dedup(spark, docs, sf).where("doc_id in (1, 7)").count() == 1


def test_stages_judge_rows_that_share_an_id(spark):
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.001"
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (None, a), (None, a + " more"), (2, b), (2, b + " more"), (2, c), (3, b), (None, "w x y z v " * 9),
            (None, "w x y z v " * 9 + "u")]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    assert [sum(r.text.startswith(x) for r in out) for x in ("a0", "b0", "c0", "w x")] == [1, 1, 1, 1]
    assert (1, a) in [tuple(r) for r in out] and (2, c) in [tuple(r) for r in out]

    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).alias("doc_id"), "text").localCheckpoint()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = importance.resample(docs, labels, carry=("text",)).collect()
    want = sorted(r.text for r in judged if r.kept and r.doc_id is None)
    assert 0 < len(want) < sum(r.doc_id is None for r in judged)
    got = corpus_pipeline.quality_classifier(spark, docs, sf).where("doc_id is null").collect()
    assert sorted(r.text for r in got) == want
