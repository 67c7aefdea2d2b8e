"""Each operator against its SQL or a plain version, on the smallest tables and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from compare import compare
from conftest import SF_DIR
from pyspark.sql import functions as F

from rimstone.llm import bpe, decontam, html, jaccard, knn, licenses, lines, quality, sharding, suffix
from rimstone.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(low(text))


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, shared ids, columns whose names operators use themselves."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    base = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, None), (2, ""), (3, "   "), (4, long), (5, long), (6, base), (6, base), (7, base + " tail"), (8, "\n\n"),
        (None, base), (None, None), (9, "Same line here now\nSame line here now\nother"), (9, "another text"),
        (10, "one"), (11, "one"), (12, "İΣ 'S <|endoftext|> 한글 \U0001f600 a\x1cb"), (13, "x" * 5000),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ["n", "place", "start", "shard", "slot", "node", "a", "b", "component", "key", "id", "hash", "lines", "gone"]
    return rows, frame.select("*", *[F.lit(1).alias(c) for c in extra], F.lit(None).cast("long").alias("n_chars"))


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql is not None])
def test_query_matches_sql(spark, duck, name):
    query, sql = QUERIES[name]
    n_rows, faults = compare(duck, query(spark, SF_DIR), sql)
    assert not faults, "\n".join(map(str, faults))
    assert n_rows > 0


def test_shards(spark, docs, awkward):
    got = QUERIES["op1_byte_prefix_shards"][0](spark, SF_DIR).collect()
    total = sum(len((t or "").encode()) + 1 for _, t in docs)
    before, slots = 0, defaultdict(int)
    at = {r.doc_id: r for r in got}
    for doc_id, text in sorted(docs):
        size = len((text or "").encode()) + 1
        shard = min((2 * before + size) * 16 // (2 * total), 15)
        r = at[doc_id]
        assert (r["size"], r.text_crc32, r.shard, r.slot) == (size, zlib.crc32((text or "").encode()), shard, slots[shard])
        before, slots[shard] = before + size, slots[shard] + 1
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    small = sharding.balanced_shards(awkward[1], 3, ["doc_id", "text"], size).collect()
    assert len(small) == len(awkward[0]) and {r.shard for r in small} <= {0, 1, 2}
    assert sharding.balanced_shards(awkward[1].limit(0), 3, ["doc_id"], size).count() == 0


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a>Menu</a></nav>"
        "<div class='ad'>Buy</div><article><h1>Head</h1><p><b>One &amp; two<br>three<p>Four</p>"
        "<aside>Side</aside></article><div class='comments'>Nice!</div><footer>&copy; Site</footer></body></html>"
    )
    plain = "<body><p>Shared top</p><p>Own {}</p><p>Shared end</p></body>"
    rows = [
        (1, "http://h.example/a/1", page), (2, "http://h.example/a/2", page[:200]), (3, None, None), (4, "", ""),
        (5, "http://p.example/x/1", plain.format(1)), (6, "http://p.example/x/2", plain.format(2)),
        (6, "http://p.example/x/2", plain.format(2)), (7, "http://q.example/", "<p>a < b &lt; c <b"), (None, "x", "<p>y"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit(0))
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html.extract_main_text(frame).collect()))
    text = {i: t for i, t, _ in got}
    assert text[1] == "Head\nOne & two three\nFour"
    assert text[3] == text[4] == "" and text[5] == "Own 1" and text[6] == "Own 2" and text[7] == "a < b < c"
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert html.extract_main_text(frame.limit(0)).count() == 0


def test_lines_of_main_outside_an_article_are_differenced(spark):
    page = "<body><p>Top</p><main><p>Read more here</p>{0}<p>Of page {1}</p></main><p>End</p></body>"
    article = "<article><p>Said twice</p></article>"
    rows = [(i, f"http://{h}.example/a/{i}", page.format(a, i)) for h, a in (("m", ""), ("n", article)) for i in (1, 2)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.url, r.text) for r in html.extract_main_text(frame).collect())
    assert [t for _, t in got] == ["Of page 1", "Of page 2", "Said twice\nOf page 1", "Said twice\nOf page 2"]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = random.Random(3)
    for _ in range(200):
        a = [draw.choice("abcd") for _ in range(draw.randint(0, 12))]
        b = [draw.choice("abcd") for _ in range(draw.randint(0, 12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        shared = [a[i] for i in sorted(html.shared_lines(a, b))]
        rest = iter(b)
        assert len(shared) == best[-1][-1] and all(x in rest for x in shared)


def test_license_templates(spark, docs, awkward):
    machine = licenses.Automaton("under the <<optional>>terms of <<optional>>the<</optional>><</optional>> <<var 2>> end")
    for text, n in (("under the x end", 4), ("under the terms of the x y end", 8), ("under the terms of x end", 6),
                    ("under the x y z end", 0), ("under the end", 0)):
        assert machine.longest(licenses.words_of(text), 0) == n, text
    for frame, rows in ((spark.read.parquet(f"{SF_DIR}/documents.parquet"), docs), (awkward[1], awkward[0])):
        got = defaultdict(list)
        for r in licenses.scan_licenses(frame).collect():
            got[r.doc_id].append((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
        want = defaultdict(list)
        for doc_id, text in rows:
            own = words(text)
            found = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(own))
                     if own[i : i + len(phrase.split())] == phrase.split()]
            ends = [i for i, _ in found]
            labels = ",".join(sorted({x for _, x in found}))
            want[doc_id].append((len(own), len(found), min(ends, default=None), max(ends, default=None), labels))
        assert {k: sorted(v, key=repr) for k, v in got.items()} == {k: sorted(v, key=repr) for k, v in want.items()}


def test_quality_on_held_out_rows(spark, awkward):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op4_factorisation_machine"][0](spark, sf).where("held_out")
    known = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in known) >= 0.88 * len(known)
    assert all(r.predicted == 1 for r in known if r.quality == 1)
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, None), (None, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        machine = quality.train(awkward[1], given)
        rows = quality.score_quality(awkward[1], machine).collect()
        assert len(rows) == len(awkward[0]) and all(0 <= r.score <= 1 for r in rows)
        assert quality.keep_good(awkward[1], machine).columns == awkward[1].columns


def test_pair_terms_in_linear_time():

    draw = np.random.default_rng(1)
    size = quality.BUCKETS + len(quality.STATS)
    machine = quality.FactorisationMachine(0.5, draw.normal(size=size), draw.normal(size=(size, 3)))
    at, x = np.array([3, 70, 500, 8000]), np.array([0.5, -1.0, 2.0, 0.25])
    pairs = sum(machine.factors[at[i]] @ machine.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert np.isclose(machine.margin(at, x), 0.5 + machine.weights[at] @ x + pairs)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 7)
    draw = random.Random(5)
    rows = [(i, [draw.choice([-0.5, 0.25, 0.5]) for _ in range(4)]) for i in range(60)]
    rows += [(i, [9.0, 9.0, 9.0, 9.0]) for i in range(60, 70)]
    bad = [(200, None), (300, [1.0, None]), (400, [float("nan")]), (None, [1.0]), (500, []), (600, [float("inf")])]
    frame = spark.createDataFrame([*rows, *rows[:3], *bad], "vec_id long, embedding array<float>")
    got = knn.top_k(knn.whole_vectors(frame.withColumn("cell", F.lit(1))), F.col("vec_id") % 20 == 0, 5).collect()
    ints = {i: [int(1024 * x // 1) for x in v] for i, v in rows}
    want = []
    for q in (0, 20, 40, 60):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, got)) == want
    few = knn.whole_vectors(frame.where("vec_id in (0, 1)"))
    assert [tuple(r)[:3] for r in knn.top_k(few, F.col("vec_id") % 20 == 0, 5).collect()] == [(0, 1, 1)]
    assert knn.top_k(few.limit(0), F.lit(True), 5).count() == 0


def test_top_k_of_repeated_ids(spark, tmp_path):
    draw = random.Random(6)
    rows = [(draw.choice([0, 100, *range(1, 25)]), [draw.choice([-0.5, 0.25, 0.5]) for _ in range(4)]) for _ in range(90)]
    rows += [(100, [0.5, 0.5, 0.5, 0.5])] * 30
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    ints = [(i, [int(1024 * x // 1) for x in v]) for i, v in rows]
    want = []
    for q in (0, 100):
        scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), j) for i, x in ints if i == q for j, y in ints if j != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:10])]
    got = QUERIES["op5_voronoi_topk"][0](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == want


def linked(rows):
    """doc_id -> (set sizes, component) by comparing all pairs."""
    sets = []
    for doc_id, text in rows:
        own = re.findall("[^\x20\x09-\x0d]+", low(text))
        sets.append((doc_id, frozenset(tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))) if own else frozenset()))
    ids = sorted({d for d, _ in sets if d is not None})
    group = {d: d for d in ids}
    for _ in ids:
        changed = False
        for i, (d, s) in enumerate(sets):
            for e, t in sets[:i]:
                if d is not None and e is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                    m = min(group[d], group[e])
                    changed |= group[d] != m or group[e] != m
                    group[d] = group[e] = m
        if not changed:
            break
    return sorted(((d, len(s), group.get(d)) for d, s in sets), key=repr)


def test_jaccard_components(spark, docs, awkward, monkeypatch):
    draw = random.Random(9)
    base = [f"t{i}" for i in range(90)]
    copies = []
    for i in range(70):
        own = list(base)
        for _ in range(draw.randint(0, 5)):
            own[draw.randrange(90)] = f"u{draw.randrange(9999)}"
        copies.append((1000 + i, " ".join(own)))
    tiny = [(2000 + i, " ".join("abcdefgh"[: 3 + i % 6])) for i in range(12)]
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    given = spark.createDataFrame([*copies, *tiny], "doc_id long, text string")
    for frame, rows in ((given, [*copies, *tiny]), (awkward[1], awkward[0])):
        found = jaccard.jaccard_components(frame).drop("text_hash").collect()
        assert sorted(map(tuple, found), key=repr) == linked(rows)
    kept = jaccard.one_of_each(given)
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in linked([*copies, *tiny])}
    assert jaccard.jaccard_components(given.limit(0)).count() == 0


def test_shared_lists_have_levels_and_come_in_passes(spark, monkeypatch):
    """Lists get their level from batches of any size; the frames of all passes together are all frames."""
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "LEVELS", 2)
    sizes = [1, 2, 1, 3, 8, 9, 40, 1, 33, 1]
    rows = [(key, node, 10 * key) for key, n in enumerate(sizes) for node in range(n) for _ in range(1 + node % 3)]
    level = {2: 0, 3: 1, 8: 1, 9: 2, 40: 2, 33: 2}
    want = [(key, node, 10 * key, level[n]) for key, n in enumerate(sizes) if n > 1 for node in range(n)]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["key", "node", "tag"])
    for step in (1, 2, 7, 20, len(rows)):
        batches = [whole.slice(i, step) for i in range(0, len(rows), step)]
        got = [tuple(r.values()) for b in jaccard.shared_lists(iter(batches)) for r in b.to_pylist()]
        assert got == want
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(5 + 7 * i))) for i in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    turns = [{tuple(r) for r in jaccard.signature_rows(frame, t).collect()} for t in range(jaccard.PASSES)]
    assert all(turns) and sum(map(len, turns)) == len(set.union(*turns))
    assert set.union(*turns) == {tuple(r) for r in jaccard.signature_rows(frame).collect()}


def test_similar_texts_with_a_common_passage(spark):
    """Pairs at 0.75 to 0.80 that share most of their shingles with a hundred other texts as well."""
    draw = random.Random(3)
    rows, want, at = [], {}, 0
    for family in range(60):
        n = draw.choice([8, 9, 10, 11, 12, 14, 20, 30]) if family % 2 else draw.choice([45, 60, 75, 90, 110, 130])
        passage = [f"p{family}x{i}" for i in range(n)]
        own = []
        for i in range(90):
            fresh = iter([f"q{family}x{i}x{j}" for j in range(3 * n)])
            head = passage[: round(n * draw.uniform(0.6, 0.8))]
            if i % 3:
                own.append([*head, *(next(fresh) for _ in range(n + 4 - len(head)))])
                continue
            apart = draw.randint(max(1, n // 5), max(2, n // 3))
            tail = [next(fresh) for _ in range(n - apart // 2 + 4 - len(head))]
            cut = draw.randint(0, apart)
            own += [[*head, *tail, *(next(fresh) for _ in range(k))] for k in (cut, apart - cut)]
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in own]
        group = list(range(at, at + len(own)))
        for i, s in enumerate(sets):
            for j, t in enumerate(sets[:i]):
                if 4 * len(s & t) >= 3 * len(s | t) and group[i] != group[j]:
                    low, high = sorted((group[i], group[j]))
                    group = [low if g == high else g for g in group]
        want |= {at + i: g for i, g in enumerate(group)}
        rows += [(at + i, " ".join(w)) for i, w in enumerate(own)]
        at += len(own)
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(given).collect()}
    assert sum(d != c for d, c in want.items()) > 500
    assert {d: (c, found[d]) for d, c in want.items() if found[d] != c} == {}


def test_allocation_covers_the_difference():
    for frame in range(2, 30):
        segments, wide, slack = jaccard.allocation(frame)
        assert segments + wide == (jaccard.BANDS[frame + 1] - 1) // 3 + 1 + slack and 0 <= wide <= segments


def test_windows_of_test_items(spark, awkward, monkeypatch):
    items = [(1, "word3 word4 word5 word6 word7 word8 word9 word10 word11 word12 word13"), (2, None), (3, "..."), (4, "one"),
             (4, "one"), (5, "absent words")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hits", F.lit(1))
    want = []
    for doc_id, text in awkward[0]:
        own, hit, found = words(text), set(), set()
        for item, phrase in items:
            parts = words(phrase)
            n = min(10, len(parts))
            for window in {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1) if parts}:
                for at in range(len(own) - n + 1):
                    if tuple(own[at : at + n]) == window:
                        hit.update(range(at, at + n))
                        found.add(str(item))
        want.append((doc_id, len(own), len(hit), sorted(found)))
    for most in (decontam.BLOCK_WINDOWS, 2):
        monkeypatch.setattr(decontam, "BLOCK_WINDOWS", most)
        rows = decontam.contamination(awkward[1], bench).collect()
        got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.hits), r["items"]) for r in rows]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert decontam.remove_contaminated(awkward[1], bench).columns == awkward[1].columns
    none = decontam.contamination(awkward[1], bench.limit(0)).collect()
    assert len(none) == len(awkward[0]) and {r.near == r.hits == r["items"] == [] for r in none} == {True}
    assert decontam.contamination(awkward[1].limit(0), bench).count() == 0


def test_proximity_against_plain_version(spark):
    """Exact and near spans of windows of four words, the rarest term of each counted over all documents."""
    draw = random.Random(12)
    docs = [(i, " ".join(draw.choice("aabbcdefg") for _ in range(draw.randint(0, 40)))) for i in range(60)]
    items = [("x", "a b c d e"), ("y", "g a"), ("z", "f"), ("w", "b b a a"), ("v", "a absent")]
    counts = defaultdict(int)
    for _, text in docs:
        for w in words(text):
            counts[w] += 1
    want = {}
    for doc_id, text in docs:
        own, spans = words(text), {0: [], 1: []}
        for _, item in items:
            parts = words(item)
            n = min(4, len(parts))
            for window in {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)}:
                rare = min(range(n), key=lambda k: (counts[window[k]], k))
                for p in [i for i, w in enumerate(own) if w == window[rare]]:
                    gaps = [
                        min((abs(i - (p - rare + k)) for i, w in enumerate(own) if w == x), default=99)
                        for k, x in enumerate(window) if k != rare
                    ]
                    if max(gaps, default=0) <= 1:
                        span = (max(p - rare, 0), min(p - rare + n, len(own)))
                        spans[max(gaps, default=0)].append(span)
        want[doc_id] = tuple(decontam.merged(spans[i]) for i in (0, 1))
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = decontam.contamination(docs, spark.createDataFrame(items, "item_id string, text string"), 4, slack=1)
    assert {r.doc_id: tuple([tuple(s) for s in c] for c in (r.hits, r.near)) for r in found.collect()} == want
    assert any(w[1] for w in want.values()) and any(w[0] for w in want.values())


def test_hot_terms_and_shared_ids_of_the_index(spark):
    """A word in every document, in lists by segment; every position is stored once."""
    from rimstone.llm.common import keyed_texts

    rows = [(i, "the " * 50 + f"w{i}") for i in range(200)]
    index = decontam.build_index(keyed_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)))
    lists = index.where(F.decode("term", "UTF-8") == "the").collect()
    assert len(lists) == 8 and sum(r.n for r in lists) == 200 * 50 == sum(len(r.positions) for r in lists)
    assert index.where("term is null").count() == 200


def test_similar_lines(spark, awkward):
    texts = [(r, t or "") for r, t in awkward[0]]
    places = sorted({(d is not None, d or 0, t) for d, t in texts}, key=lambda p: p[:2])
    rows = lines.remove_similar_lines(awkward[1].withColumn("n_lines", F.lit(0))).collect()
    assert len(rows) == len(texts) and places
    kept = defaultdict(set)
    for r in rows:
        kept[r.doc_id].add((r.text, r.n_lines, r.n_removed))
    assert kept[9] == {("Same line here now\nother", 3, 1), ("another text", 1, 0)}
    assert kept[10] == {("one", 1, 0)} and kept[11] == {("", 1, 1)} and kept[8] == {("\n\n", 3, 0)}
    assert kept[6] == {("", 1, 1)} and kept[1] == {("", 1, 0)} and kept[5] == {("", 1, 1)}  # doc_id null stands first
    assert lines.remove_similar_lines(awkward[1].limit(0)).count() == 0


@pytest.mark.parametrize("percent", [34, 50, 60, 66, 67, 75, 100])
def test_similar_lines_at_any_percent(spark, percent):
    draw = random.Random(percent)
    rows = [(i, " ".join(draw.sample("abcde", draw.randint(1, 4)))) for i in range(40)]
    rows += [(100, "x y"), (101, "x y z"), (102, "v"), (103, "v w"), (104, "w v")]
    sets = [(d, frozenset(t.split())) for d, t in rows]
    want = {
        d: any(100 * len(s & o) >= percent * len(s | o) for _, o in sets[:i]) for i, (d, s) in enumerate(sets)
    }
    got = lines.remove_similar_lines(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    assert {r.doc_id: r.n_removed == 1 for r in got.collect()} == want
    for wrong in (0, 101):
        with pytest.raises(ValueError):
            lines.remove_similar_lines(got, percent=wrong)


def test_earliest_line_of_a_word_is_joined(spark):
    """A word of very many lines is not gathered in one task: no window, and both sides of the join can be split."""
    rows = [(k, i, i % 7, 0, (4 + i % 3) << 32) for k in (1, 2) for i in range(50)] + [(3, 99, 0, 0, 5 << 32)]
    words = spark.createDataFrame(rows, "key int, id long, bits long, more_bits long, packed long").repartition(4)
    led = lines.with_leads(words)
    size = lambda packed: int(2 * math.log2(packed >> 32)) % lines.SIZES
    got = {(r.key, r.id): [r[name].id for name in lines.lead_names() if r[name]] for r in led.collect()}
    assert set(got) == {(k, i) for k, i, *_ in rows if i > min(r[1] for r in rows if r[0] == k)}
    size_of = {(k, i): size(packed) for k, i, *_, packed in rows}
    for (key, _), leads in got.items():
        kinds = {size_of[r[:2]] for r in rows if r[0] == key}
        firsts = {min(i for (k, i), s in size_of.items() if (k, s) == (key, kind)) for kind in kinds}
        assert firsts <= set(leads) and len(leads) == 2 * len(kinds)  # the other one of a kind has the other hash
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = lines.with_leads(words)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in plan and "Aggregate" not in plan and plan.count("ENSURE_REQUIREMENTS") == 2


def without_repeats(rows, length):
    coded = [(d, (t or "").encode()) for d, t in rows]
    seen = defaultdict(int)
    for _, b in coded:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] += 1
    out = []
    for d, b in coded:
        gone = set()
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone.update(range(i, i + length))
        spans = sum(i not in gone and i + 1 in gone for i in range(-1, len(b)))
        kept = bytes(x for i, x in enumerate(b) if i not in gone)
        out.append((d, len(b), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [suffix.HOT_CONTEXTS, 1])
def test_repeated_passages(spark, awkward, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT_CONTEXTS", hot)
    draw = random.Random(11)
    text = "".join(draw.choice("abcdé ") for _ in range(400))
    rows = [(i, text[draw.randrange(300) :][: draw.randrange(20, 200)] + draw.choice("xyz") * 9) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffix.remove_repeats(frame, 40, True).collect()), key=repr) == without_repeats(rows, 40)
    short = [(d, t if t is None else t[:6000]) for d, t in awkward[0]]
    cut = awkward[1].withColumn("text", F.substring("text", 1, 6000))
    assert sorted(map(tuple, suffix.remove_repeats(cut, 60, True).collect()), key=repr) == without_repeats(short, 60)
    whole = suffix.remove_repeats(frame, 40).collect()
    assert sum(s.end - s.start for r in whole for s in r.spans) == sum(x[2] for x in without_repeats(rows, 40))
    assert suffix.remove_repeats(frame.limit(0), 40).count() == 0


def test_suffix_sort_is_verified(monkeypatch):

    draw = random.Random(2)
    rows = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(60)]
    sorter = suffix.Suffixes(*suffix.padded(rows, 9))
    order, _ = sorter.sort()
    assert [rows[i] for i in order] == sorted(rows)
    sorter.sums[:] = 0  # all hashes collide
    order, common = sorter.sort()
    assert [rows[i] for i in order] == sorted(rows)
    assert isinstance(common, np.ndarray) and max(common) < 9


def test_tokens_and_their_text(spark, docs, awkward):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for frame, rows in ((spark.read.parquet(f"{SF_DIR}/documents.parquet"), docs), (awkward[1], awkward[0])):
        want = []
        for doc_id, text in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids
            want.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
        got = [(r.doc_id, list(r.ids), r.decoded) for r in bpe.encode_documents(frame).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        digests = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe.encode_documents(frame, digest=True).collect()}
        assert digests == {(d, len(i), hashlib.sha256(t.encode()).hexdigest()) for d, i, t in want}


def test_streamed_encoding_needs_its_lookahead_only():
    import public_tokenizers

    merges = bpe.Merges(bpe.Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8"))
    draw = random.Random(4)
    for letters in ("a", "ab", "etaoinshr", "abcdefghijklmnopqrstuvwxyz"):
        for n in (1, 40, 200, 900):
            symbols = list(merges.symbols("".join(draw.choice(letters) for _ in range(n)).encode()))
            assert list(merges.stream(iter(symbols))) == merges.merge(symbols)
    assert "".join(bpe.to_text([b"\xed\x95", b"\x9c a", b"\xf0\x9f"])) == "한 a�"


def test_one_very_long_word_is_encoded_while_it_is_read():
    """What the transducer has read and not yet sent is a few lookaheads at any time, however long the word."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = bpe.Encoder(bpe.read_vocabulary(None, path))
    merges, draw = encoder.merges, random.Random(8)
    word = "".join(draw.choice("etaoinshr") for _ in range(60_000))
    n_read = n_sent = most = 0

    def reading():
        nonlocal n_read
        for symbol in merges.symbols(word.encode()):
            n_read += 1
            yield symbol

    for token in merges.stream(reading()):
        most = max(most, n_read - n_sent)
        n_sent += len(merges.spelled[token])
    assert n_sent == len(word) and most <= 8 * merges.lookahead
    spelled = {i: s.encode() for i, s in merges.text.items()}
    library = Tokenizer.from_file(path)
    ids = library.encode(word, add_special_tokens=False).ids
    text = library.decode(ids, skip_special_tokens=False)
    want = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(encoder.encode(word), spelled) == want


def test_windows_end_at_blanks():
    draw = random.Random(3)
    for _ in range(200):
        text = "".join(draw.choice("ab  \u0301\n") for _ in range(draw.randint(0, 60)))
        parts = list(bpe.windows(text, 7))
        assert "".join(parts) == text and all(p.startswith(" ") for p in parts[1:])


def test_one_line_with_very_many_near_copies(spark):
    """Near copies of several sizes are decided by their leads, so few pairs remain and all but the first go."""
    base = [f"word{i}" for i in range(24)]
    rng = random.Random(3)
    rows = [(0, " ".join(base))]
    for i in range(1, 600):
        kept = [w for w in base if rng.random() > 0.08]
        rows.append((i, " ".join([*kept, *(f"own{i}x{j}" for j in range(rng.randrange(3)))])))
    sets = [(i, set(t.split())) for i, t in rows]
    want = {i for i, s in sets if any(100 * len(s & o) >= 75 * len(s | o) for j, o in sets[:i])}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, plain = [], lines.verified

    def counted(pairs, *others):
        pairs = lines.materialize(pairs, "counted")
        made.append(pairs.count())
        return plain(pairs, *others)

    lines.verified = counted
    try:
        got = {r["__id"] for r in lines.lines_to_remove(docs).collect()}
    finally:
        lines.verified = plain
    assert got == want and len(want) > 500
    assert sum(made) < 20 * len(rows)  # of 180,000 pairs


def test_leads_are_found_for_some_words_at_a_time(spark, monkeypatch):
    """No pass has all prefix words on disk, each word is in one, and the lines that go are those of a plain version."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.sample([f"w{j}" for j in range(9)], 6))) for i in range(60)]
    sets = [(i, set(t.split())) for i, t in rows]
    want = {i for i, s in sets if any(100 * len(s & o) >= 70 * len(s | o) for _, o in sets[:i])}
    keys, plain = [], lines.with_leads

    def seen(words):
        keys.append({r.key for r in words.select("key").distinct().collect()})
        return plain(words)

    monkeypatch.setattr(lines, "with_leads", seen)
    got = lines.lines_to_remove(spark.createDataFrame(rows, "doc_id long, text string"), percent=70)
    assert {r["__id"] for r in got.collect()} == want and len(want) < len(rows)
    assert len(keys) == lines.PASSES > 1 and sum(map(len, keys)) == len(set.union(*keys)) > max(map(len, keys))


def test_pairs_are_found_for_some_words_at_a_time_and_leads_go(spark, monkeypatch):
    """No pass of the join has all prefix words on disk, and the leads and marks of finished passes are removed."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.sample([f"w{j}" for j in range(9)], 6))) for i in range(60)]
    sets = [(i, set(t.split())) for i, t in rows]
    want = {i for i, s in sets if any(100 * len(s & o) >= 70 * len(s | o) for _, o in sets[:i])}
    keys, files, plain, discard = [], [], lines.met_by, lines.discard

    def seen(words, percent):
        keys.append({r.key for r in words.select("key").distinct().collect()})
        return plain(words, percent)

    def gone(df, label):
        mine = [f.removeprefix("file:").rsplit("/", 1)[0] for f in df.inputFiles() if f"/{label}-" in f]
        assert mine and all(map(os.path.isdir, mine))
        discard(df, label)
        files.extend(mine)

    monkeypatch.setattr(lines, "met_by", seen)
    monkeypatch.setattr(lines, "discard", gone)
    got = lines.lines_to_remove(spark.createDataFrame(rows, "doc_id long, text string"), percent=70)
    assert {r["__id"] for r in got.collect()} == want and len(want) < len(rows)
    assert len(keys) == lines.PASSES > 1 and sum(map(len, keys)) == len(set.union(*keys)) > max(map(len, keys))
    assert len(set(files)) == lines.PASSES + 1 and not any(map(os.path.exists, files))


def test_rarity_classes_come_as_one_text(spark):
    texts = spark.createDataFrame([("a b a",), ("a\n",)], "text string")
    (classes,) = spark.range(1).select(lines.rarity_classes(texts)).first()
    counts = {}
    for word, n in (("a", 3), ("b", 1), ("", 1)):
        (h,) = spark.range(1).select(F.xxhash64(F.lit(word)).bitwiseAND(lines.BUCKETS - 1)).first()
        counts[h] = counts.get(h, 0) + n
    assert len(classes) == lines.BUCKETS
    assert {i: c for i, c in enumerate(classes) if c} == {h: int(2 * math.log2(n + 1)) for h, n in counts.items()}


def test_a_worker_reads_the_vocabulary_once(spark, tmp_path, monkeypatch):
    log, made = str(tmp_path / "made"), bpe.Encoder

    def counted(file):
        import os

        with open(log, "a") as out:
            out.write(f"{os.getpid()}\n")
        return made(file)

    monkeypatch.setattr(bpe, "Encoder", counted)
    frame = spark.createDataFrame([(i, f"word {i}") for i in range(64)], "doc_id long, text string").repartition(32)
    assert len(bpe.encode_documents(frame, digest=True).collect()) == 64
    with open(log) as read:
        workers = read.read().split()
    assert workers and len(workers) == len(set(workers))
