"""Content sort, hybrid ranking and trie collocations against plain versions, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rimstone.llm import components, content_sort, phrases, ranking

SCHEMA = "doc_id long, text string, lang string, n long, slot int, word string"


def awkward(spark, seed: int = 5, n: int = 300):
    """Rows with nulls everywhere, empty and very long texts, repeated rows and columns with names used inside."""
    pick = random.Random(seed)
    vocabulary = ["a", "The", "the", "ünder", "x1", "b-c", "dé", "o", "あい", "zz", "q'r"]
    rows = []
    for i in range(n):
        words = [pick.choice(vocabulary) for _ in range(pick.choice([0, 1, 2, 3, 9, 40]))]
        text = "".join(w + pick.choice([" ", " ", "\t", ". ", "\n", "\r\n", "  ", " "]) for w in words)
        rows.append((pick.choice([i, i % 50, None]) if i % 9 == 0 else i, text, pick.choice(["en", "de", None, "und"])))
    rows += [(900, None, "en"), (901, "", None), (None, None, None), (902, " \t\n", "en"), (902, " \t\n", "en")]
    rows += [(903, "The the " * 60_000, "en"), (904, "The\nthe " * 60_000, "en")]
    rows += [(1000 + i, "one hot text , again", "en") for i in range(n // 2)] + rows[:20]
    return spark.createDataFrame([(*r, 1, 2, "w") for r in rows], SCHEMA), rows


def plain_duplicates(rows):
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        kept = True
        for m in sorted(members, key=lambda m: m != best):
            digest = hashlib.sha256(norm.encode()).hexdigest()
            out.append((m[0], best[0], len(members), kept and m == best, digest))
            kept = False
    return Counter(out)


@pytest.mark.parametrize("parts", ["3", "40"])
def test_content_sort_against_plain_version(spark, parts):
    """With 40 partitions the hot text is dealt to slots, with 3 less so."""
    docs, rows = awkward(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = Counter(tuple(r) for r in content_sort.exact_duplicates(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain_duplicates(rows)


def test_content_sort_has_one_exchange_of_texts_and_no_python(spark):
    docs, _ = awkward(spark, n=20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        plan = content_sort.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition") == 1
    assert "hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(ranking.TERM, lowered)


def plain_ranking(rows, items, k=10):
    docs = [(doc_id, Counter(plain_terms(text))) for doc_id, text, _ in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    held = Counter(t for _, c, _ in docs for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id] |= set(plain_terms(text))
    out = []
    for item_id, terms in asked.items():
        scores = []
        for doc_id, c, n in docs:
            m = 10 + 90 * n * n_docs // n_terms
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], start=1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_bytes, long, most", [(8 << 20, 8, 1 << 18), (2000, 2, 12), (700, 10**9, 1)])
def test_ranking_against_plain_version(spark, monkeypatch, shard_bytes, long, most):
    """One shard or many, all lists long or hardly any, items in one block or each by itself."""
    monkeypatch.setattr(ranking, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(ranking, "LONG", long)
    monkeypatch.setattr(ranking, "BLOCK", 4)
    docs, rows = awkward(spark)
    items = [(1, "The x1 dé"), (2, "nothing here"), (3, None), (4, "a a A o zz"), (5, ""), (None, "hot again one"),
             (6, "あい b"), (7, "c"), (7, "Ünder ünder")]
    table = spark.createDataFrame([(*i, "t", 3) for i in items], "item_id long, text string, term string, w int")
    got = sorted((tuple(r) for r in ranking.rank_documents(docs, table, most=most).collect()), key=repr)
    assert got == plain_ranking(rows, items)


def test_ranking_skips_blocks_that_cannot_matter():
    """Blocks whose bounds do not reach the tenth best score are never read."""
    best = ranking.Best(1, 2)
    best.add(0, np.array([90, 80]), np.array([1, 2]), np.array([False, False]))
    best.add(0, np.array([80, 70]), np.array([0, 3]), np.array([True, False]))
    assert best.bar(0) == 80 and best.kept[0][1].tolist() == [1, 2]


def plain_collocations(rows, max_words, least, covered, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        listed = []
        for p in candidates:
            longer = [q for q in candidates if len(q) > len(p)]
            longer = [q for q in longer if any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * f[q] >= covered * f[p] for q in longer):
                continue
            score, k = min((1_000_000 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            listed.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(listed)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("max_words, slice_bytes, most", [(3, 8 << 20, 1 << 19), (3, 900, 5), (4, 3000, 40), (2, 50, 1)])
def test_collocations_against_plain_version(spark, monkeypatch, max_words, slice_bytes, most):
    """One run or many, one trie or one for a few phrases, phrases of up to four words."""
    monkeypatch.setattr(phrases, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(phrases, "MOST_KEYS", 7)
    docs, rows = awkward(spark)
    got = phrases.collocations(docs, max_words=max_words, least=4, covered=60, top=60, most=most).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, max_words, 4, 60, 60)


def test_trie_finds_what_a_dictionary_finds():
    pick = np.random.default_rng(3)
    for depth, n_words in ((2, 40), (3, 12), (2, 700)):
        listed = np.unique(pick.zipf(1.3, size=(3000, depth)) % n_words * 3, axis=0)
        trie = phrases.Trie(listed)
        where = {tuple(p): i for i, p in enumerate(listed.tolist())}
        ids = (pick.zipf(1.3, size=5000) % (n_words + 5) * 3).astype(np.int32)
        ids[::17] = phrases.STOP
        ids[::23] = phrases.RARE
        want = [where.get(tuple(ids[i : i + depth].tolist()), -1) if i + depth <= len(ids) else -1 for i in range(len(ids))]
        assert trie.accept(ids).tolist() == want
        assert len(trie.check) < 2 * (len(listed) + sum(trie.level_sizes) + n_words) + 10
        for short in range(depth + 1):
            assert len(trie.accept(ids[:short])) == short


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_017
    levels = {
        1: spark.createDataFrame([([1], big * 7), ([2], big * 5)], "words array<int>, f long"),
        2: spark.createDataFrame([([1, 2], big)], "words array<int>, f long"),
    }
    (row,) = phrases.with_scores(levels, 2).collect()
    assert row["score"] == 1_000_000 * big * big // (big * 7 * big * 5) and (row["l"], row["r"]) == (big * 7, big * 5)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert content_sort.exact_duplicates(docs).count() == 0
    assert ranking.rank_documents(docs, one).count() == 0
    assert ranking.rank_documents(awkward(spark, n=3)[0], items).count() == 0
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, 1, 2, "w")], SCHEMA)).count() == 0


@pytest.mark.parametrize("shape", ["in order", "at random", "stars"])
def test_components_of_long_chains_take_few_rounds(spark, monkeypatch, shape):
    n = 2000
    ids = list(range(n))
    if shape == "at random":
        random.Random(2).shuffle(ids)
    edges = list(zip(ids, ids[1:], strict=False))
    if shape == "stars":
        edges = [(0, i) for i in range(1, 900)] + [(1500, i) for i in range(901, 1499)] + [(899, 1600), (1600, 1600)]
    written = []
    whole = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: written.append(label) or whole(df, label))
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    if shape == "stars":
        want = {i: 0 for i in [*range(900), 1600]} | {i: 901 for i in [*range(901, 1499), 1500]}
    else:
        want = dict.fromkeys(range(n), 0)
    assert got == want
    assert written.count("pointers") <= 15
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).isEmpty()
