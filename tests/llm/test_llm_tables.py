"""Each training-data query against a brute-force version on the whole sf0.001 tables."""

import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name, key):
    return {r[key]: r for r in E.queries()[name](spark, SF).collect()}


def test_rule_ledger(spark, docs):
    got = rows(spark, "op4_rule_ledger", "doc_id")
    assert set(got) == set(docs)
    for i, text in docs.items():
        w = WORD.findall(text or "")
        at = collections.defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k:k + 3])].append(k)
        rep = len({k + j for v in at.values() if len(v) > 1 for k in v for j in range(3)})
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep)
        assert g.base_failed == (len(w) < 50 or 100 * rep > 50 * len(w))
        assert not (g.base_failed and g.kept)


def test_near_duplicates(spark, docs):
    got = rows(spark, "op5_tensor_minhash", "doc_id")
    sets = {}
    for i, text in docs.items():
        w = WORD.findall(lower(text))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    component = {i: i for i in docs}
    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = component[a], component[b]
                    component = {k: min(x, y) if v in (x, y) else v for k, v in component.items()}
    for i in ids:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), component[i], component[i] == i)


def test_embedding_links(spark):
    got = rows(spark, "op2_lattice_links", "vec_id")
    data = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    v = np.array([r.embedding for r in data], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    for r, n in zip(data, (v @ v.T >= 0.95).sum(axis=1) - 1):
        assert got[r.vec_id].n_links == n


def test_conversations(spark):
    got = rows(spark, "op3_reply_trees", "conv_id")
    by = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        by[r.conv_id].append((r.turn, r.role, r.text or ""))
    by[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_notices(spark, docs):
    got = rows(spark, "op6_fuzzy_notices", "doc_id")
    base = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for i, text in docs.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        at = [(k, x) for p, x in base.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        g = got[i]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == (
            len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(","))
        assert 0 <= g.score <= 1


def test_packing(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in E.queries()["op7_bestfit_packing"](spark, SF).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    total = 0
    for i, text in docs.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            part = ids[at:at + r.length]
            assert (r.piece, r.start, len(part)) == (k, at, r.length)
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(sequences) <= 1.05 * -(-total // 1024) + 1


def test_merge_dropout(spark, docs):
    got = rows(spark, "op9_merge_dropout", "doc_id")
    for i, text in docs.items():
        assert (got[i].decoded_chars, got[i].decoded_crc32) == (len(text or ""), zlib.crc32((text or "").encode()))


def test_language(spark):
    got = rows(spark, "op10_byte_cnn", "doc_id")
    right = held = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if g.held_out and r.lang:
            held += 1
            right += g.lang_pred == r.lang
    assert right >= 0.9 * held


def test_main_text(spark):
    got = rows(spark, "op1_wrappers", "page_id")
    import html
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", body.group(1)) if body else []
        want = "\n".join(filter(None, (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in parts)))
        assert got[r.page_id].text == want


def test_resampling_keeps_labelled_good(spark):
    got = rows(spark, "op8_importance_resampling", "doc_id")
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1 and not r.toxic]
    assert sum(got[i].kept for i in good) >= 0.97 * len(good)


def test_pipeline_is_its_stages(spark, docs):
    import corpus_pipeline as P
    rows_ = spark.read.parquet(f"{SF}/documents.parquet")
    seen = set(docs)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, rows_, SF)
        assert out.columns == rows_.columns, name
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= seen and len(kept) > len(seen) // 2
        rows_, seen = spark.createDataFrame(out.collect(), out.schema), kept
    packed = E.queries()["pipeline"](spark, SF).collect()
    assert {r.doc_id for r in packed} == seen
