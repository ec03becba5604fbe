"""Resampling, the pipeline's kept rows and fuzzy notices against plain loops over whole texts."""

import collections
import math
import random
import re

import pytest
import xxhash

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SPACES = r"\x20\x09-\x0D"
WORD = re.compile(rf"[^{SPACES}]+")
U64 = (1 << 64) - 1


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & U64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & U64
    return x ^ x >> 31


def grams(text):
    """Bucket counts of a text's words and word pairs."""
    words = [xxhash.xxh3_64_intdigest(w.encode()) for w in WORD.findall(text or "")]
    pairs = [mixed((a * 0x9E3779B97F4A7C15 + b) & U64) for a, b in zip(words, words[1:])]
    return collections.Counter(x % 65536 for x in words + pairs)


def resampled(docs, good, prior=4.0, temper=200, miss=0.002, seed=8):
    """{id: (n_grams, log_weight, kept)} of {id: text}; ``good`` are the ids of labelled good documents."""
    of = {i: grams(t) for i, t in docs.items()}
    raw, target = collections.Counter(), collections.Counter()
    for i, c in of.items():
        raw.update(c)
        if i in good:
            target.update(c)
    share = sum(target.values()) / sum(raw.values())
    weight, score = {}, {}
    for i, c in of.items():
        total = sum(c.values())
        if not total:
            continue
        mine = 1 if i in good else 0
        s = sum(n * math.log((target[b] - mine * n + prior) / (share * (raw[b] - n) + prior)) for b, n in c.items())
        weight[i] = s * min(1.0, temper / total)
        u = (xxhash.xxh3_64_intdigest(b"%d\x00%d\x00" % (seed, i) + docs[i].encode()) + 0.5) / 2.0**64
        score[i] = weight[i] - math.log(-math.log(u))
    targets = sorted((weight[i] for i in weight if i in good), reverse=True)
    floor = targets[len(targets) - int(miss * len(targets)) - 1]
    k = sum(w >= floor - 1e-9 for w in weight.values())
    drawn = set(sorted(score, key=score.get, reverse=True)[:k])
    return {i: (sum(c.values()), weight.get(i, 0.0), i in drawn) for i, c in of.items()}


def passes_rules(text):
    text = text or ""
    w = WORD.findall(text)
    at = collections.defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    repeated = len({k + j for v in at.values() if len(v) > 1 for k in v for j in range(3)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = len(lines) - len(set(lines))
    chars, upper = sum(map(len, w)), sum(c.isupper() and c.isalpha() for c in text)
    return not (len(w) < 50 or 100 * repeated > 50 * len(w) or 4 * len(re.findall(r"[#*$%&|<>]", text)) > len(w)
                or again >= 3 and 10 * again > 3 * len(lines) or not 2 * len(w) <= chars <= 25 * len(w)
                or 2 * upper > chars or 4 * text.count("!") > len(w))


def least_of_groups(docs, percent):
    """Ids that are the least of the documents they link with, over any number of links."""
    sets = {}
    for i, t in docs.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group(0).lower(), t or ""))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    least = {i: i for i in docs}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i
    for a in sorted(docs):
        for b in sorted(docs):
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    least[y] = x
    return {i for i in docs if top(i) == i}


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def good(spark):
    verdicts = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        verdicts[r.doc_id].append(r.quality == 1 and r.toxic != 1)
    return {i for i, v in verdicts.items() if all(v)}


def test_resampling(spark, docs, good):
    expected = resampled(docs, good)
    got = E.queries()["op8_importance_resampling"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n, weight, kept = expected[r.doc_id]
        assert (r.n_grams, r.kept) == (n, kept)
        assert r.log_weight == pytest.approx(weight, abs=1e-6)


def test_pipeline_keeps_what_plain_loops_keep(spark, docs, good):
    left = {i: t for i, t in docs.items() if passes_rules(t)}
    drawn = resampled(left, good)
    left = {i: t for i, t in left.items() if drawn[i][2]}
    left = least_of_groups(left, 80)
    packed = E.queries()["pipeline"](spark, SF).collect()
    assert 0 < len(left) < len(docs)
    assert {r.doc_id for r in packed} == left
    places = collections.defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for s in places.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024


def distances(notice, text):
    """Edit distance of the notice to each beginning of the text."""
    row = list(range(len(text) + 1))
    for i, c in enumerate(notice, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row


@pytest.mark.parametrize("seed", range(6))
def test_fuzzy_spans(seed):
    from tidalrec.llm.notices import NOTICES, Finder, Search
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz "
    parts = []
    for _ in range(5):
        parts += rng.choices(["any", "license", "rights", "mit", "of", "granted", "under", "x", "public"], k=rng.randint(0, 3))
        notice = list(rng.choice(list(NOTICES)))
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(notice))
            notice[at:at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
        parts.append("".join(notice))
    joined = " " + " ".join(" ".join(parts).split()) + " "
    found = Finder(Search()).find(joined)[2]
    assert found
    allowed = {n: max(1, min(4, len(n) // 12)) for n in NOTICES}
    for label, start, end, edits, similarity in found:
        assert any(x == label and distances(n, joined[start:end])[-1] <= edits <= allowed[n]
                   and similarity == pytest.approx(1 - edits / len(n)) for n, x in NOTICES.items())
    starts = [m.start() + 1 for m in re.finditer(" ", joined)][:-1]
    for notice, label in NOTICES.items():
        for s in starts:  # wherever a notice begins within its edits, a verified span of its label lies
            near = distances(notice, joined[s:s + len(notice) + allowed[notice]])
            if min(near) <= allowed[notice]:
                assert any(x == label and a < s + near.index(min(near)) and s < b for x, a, b, _, _ in found), (notice, s)
