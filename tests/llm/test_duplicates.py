"""Jaccard components, repeated passages and embedding links against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marketweave.llm import components, embeddings, jaccard, queries, substrings
from marketweave.llm import words as wd
from tests.conftest import SMALL
from tests.llm import brute

SIM = jaccard.Similarity(3, 70, 100)


def varied(n_base=12, copies=9, seed=1):
    """Texts with near copies of many degrees, chains, exact copies and a shared passage."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    shared = " ".join(rng.choices(vocab, k=60))
    out = []
    for b in range(n_base):
        base = rng.choices(vocab, k=rng.choice([2, 3, 30, 90, 200]))
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 8))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.2:
                w = w[: max(1, len(w) - rng.randint(0, len(w) // 6))]
            t = " ".join(w)
            if b % 3 == 0 and len(w) > 20:
                t += "\n" + shared
            out.append(t.upper() if rng.random() < 0.1 else t)
        out.append(out[-1])
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def check_jaccard(rows, ids, texts, sim):
    want = brute.components(range(len(ids)), brute.jaccard_links(texts, sim.n, sim.num, sim.den))
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ids)
    for k, i in enumerate(ids):
        assert got[i]["component_id"] == ids[want[k]], i
        assert got[i]["n_shingles"] == len(brute.shingle_set(texts[k], sim.n))


@pytest.mark.parametrize("sim", [SIM, jaccard.Similarity(4, 85, 100), jaccard.Similarity(2, 50, 100)])
def test_jaccard_components_equal_brute_force(spark, sim):
    texts = varied()
    check_jaccard(jaccard.jaccard_components(frame(spark, texts), sim).collect(),
                  list(range(len(texts))), texts, sim)


def test_jaccard_large_trees_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "ONE_NODE", 3)
    texts = varied(6, 14, seed=4)
    check_jaccard(jaccard.jaccard_components(frame(spark, texts), SIM).collect(),
                  list(range(len(texts))), texts, SIM)


def test_jaccard_query(spark, documents):
    ids, texts = [i for i, _, _ in documents], [t for _, t, _ in documents]
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    rows = queries.QUERIES["op3_jaccard_join"](spark, SMALL).collect()
    check_jaccard(rows, [ids[k] for k in order], [texts[k] for k in order], jaccard.Similarity(4, 85, 100))


def test_jaccard_odd_rows(odd_docs, odd_rows, no_docs):
    rows = jaccard.jaccard_components(odd_docs, SIM).collect()
    assert len(rows) == len(odd_rows)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert by[1][0]["component_id"] == by[1][1]["component_id"] == by[2][0]["component_id"] == 1
    for i in (3, 4, 5):
        assert (by[i][0]["n_shingles"], by[i][0]["component_id"]) == (0, i)
    assert by[9][0]["n_shingles"] == 1 and by[None][0]["component_id"] is None
    assert jaccard.jaccard_components(no_docs, SIM).count() == 0
    kept = jaccard.one_of_each(odd_docs, SIM)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert jaccard.one_of_each(no_docs, SIM).count() == 0


def test_box_join_loses_no_pair():
    rng = np.random.default_rng(2)
    p = rng.poisson(4, (300, 16))
    p[150:] = np.maximum(0, p[:150] + rng.integers(-1, 2, (150, 16)))
    size = p.sum(1)
    sim = jaccard.Similarity(3, 80, 100)
    got = {tuple(sorted(x)) for x in jaccard.box_join(p, size, sim).tolist()}
    want = {(i, j) for i in range(300) for j in range(i + 1, 300)
            if sim.linked(int(np.minimum(p[i], p[j]).sum()), int(size[i] + size[j]))}
    assert got == want


def test_points_bound_the_overlap():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:500], rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    (x, _), (y, _) = (jaccard.points(s, np.array([0, len(s)])) for s in (a, b))
    assert len(np.intersect1d(a, b)) <= np.minimum(x, y).sum() <= len(b)


def test_components_of_a_long_chain(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000), (5, 5), (2000, 2001), (2001, 2000)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {2000: 2000, 2001: 2000}
    none = spark.createDataFrame([], "u long, v long")
    assert components.connected_components(none).count() == 0


def cartesian_windows(v, width):
    """All nodes of the Cartesian tree whose window has ``width`` entries or more."""
    out, todo = [], [(0, len(v) - 1)]
    while todo:
        lo, hi = todo.pop()
        if hi - lo + 1 < width:
            continue
        c = min(range(lo, hi + 1), key=lambda i: v[i])
        out.append((lo, c, hi))
        todo += [(lo, c - 1), (c + 1, hi)]
    return sorted(out)


def test_compact_windows_are_the_tops_of_the_trees():
    rng = np.random.default_rng(4)
    for width, sizes in ((5, [0, 3, 5, 40, 200]), (7, [6, 7, 8, 60])):
        stop = np.cumsum(sizes)
        start = stop - sizes
        sh = rng.integers(0, 1 << 63, int(stop[-1]), dtype=np.uint64)
        salt = np.uint64(77)
        row, left, c, right = substrings.compact_windows(sh, start, stop, width, salt)
        v = (substrings.order_hash(sh, salt) >> np.uint64(30)).tolist()
        for i, (a, b) in enumerate(zip(start.tolist(), stop.tolist())):
            own = sorted((int(x) - a, int(y) - a, int(z) - a)
                         for r, x, y, z in zip(row, left, c, right) if r == i)
            assert own == cartesian_windows(v[a:b], width)


def check_passages(rows, texts, least):
    """``texts`` by id: every exact repeat is covered, every reported passage is similar."""
    w = {i: brute.words(brute.lower(t)) for i, t in texts.items()}
    first, must, cover = {}, defaultdict(set), defaultdict(set)
    for i in sorted(w):
        for s in range(len(w[i]) - least + 1):
            f = first.setdefault(tuple(w[i][s:s + least]), i)
            if f != i:
                must[i].update(range(s, s + least))
    for r in rows:
        assert r["match_doc_id"] < r["doc_id"] and min(r["n_words"], r["match_n_words"]) >= least
        a = w[r["doc_id"]][r["start_word"]:r["start_word"] + r["n_words"]]
        b = w[r["match_doc_id"]][r["match_start_word"]:r["match_start_word"] + r["match_n_words"]]
        x, y = ({tuple(s[k:k + 5]) for k in range(len(s) - 4)} for s in (a, b))
        assert len(x & y) / len(x | y) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8
        cover[r["doc_id"]].update(range(r["start_word"], r["start_word"] + r["n_words"]))
    for i in must:
        assert must[i] <= cover[i], i
    return must, cover


def test_passages_query(spark, documents):
    rows = queries.QUERIES["op7_substring_dedup"](spark, SMALL).collect()
    must, _ = check_passages(rows, {i: t for i, t, _ in documents}, 50)
    assert must


def planted(seed=6):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(2000)]
    passage = rng.choices(vocab, k=70)
    texts = {}
    for i in range(60):
        w = rng.choices(vocab, k=rng.randint(5, 150))
        if i % 3 == 0:
            own = list(passage)
            if i % 9 == 0:
                own[35] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = own
        texts[i] = " ".join(w)
    return texts


def test_planted_passages_and_no_others(spark):
    texts = planted()
    rows = substrings.repeated_passages(frame(spark, list(texts.values()))).collect()
    must, cover = check_passages(rows, texts, 50)
    assert set(must) <= set(cover) <= {i for i in texts if i % 3 == 0}
    assert {i for i in texts if i % 3 == 0} - {0} == set(cover)


def test_texts_without_their_repeats(spark):
    texts = planted()
    docs = frame(spark, list(texts.values())).selectExpr("doc_id", "text", "length(text) AS n_chars")
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(got[i]["n_chars"] == len(got[i]["text"]) for i in got)
    assert all(got[i]["text"] == texts[i] for i in texts if i % 3 or i == 0)
    assert all(len(brute.words(got[i]["text"])) <= len(brute.words(texts[i])) - 50
               for i in got if i % 3 == 0 and i)
    assert substrings.repeated_passages(out).count() == 0


def test_passages_odd_rows(spark, odd_docs, odd_rows, no_docs):
    long = next(t for i, t, _ in odd_rows if i == 6)
    more = spark.createDataFrame([(30, "before " + long, "a") + ("z",) * 8, (31, None, "a") + ("z",) * 8],
                                 odd_docs.schema)
    rows = substrings.repeated_passages(odd_docs.unionByName(more)).collect()
    assert {(r["doc_id"], r["match_doc_id"]) for r in rows} == {(30, 6)}
    assert sum(r["n_words"] for r in rows if r["match_start_word"] == 0) >= 30_000
    left = substrings.without_repeats(odd_docs.unionByName(more))
    assert {r["doc_id"]: r["text"] for r in left.collect()}[30].split() == ["before"]
    assert left.count() == len(odd_rows) + 2
    assert substrings.repeated_passages(no_docs).count() == 0
    assert substrings.without_repeats(no_docs).count() == 0


def vectors(seed=8, dim=12):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(25):
        base = rng.normal(size=dim)
        for _ in range(rng.integers(1, 14)):
            out.append((base + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.15])) * rng.uniform(0.1, 9))
    return [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in enumerate(out)]


def check_links(rows, vecs, least):
    usable = {i: np.array(v, dtype=np.float64) for i, v, lab in vecs
              if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: lab for i, _, lab in vecs}
    pairs = []
    for i in usable:
        for j in usable:
            if i < j and label[i] == label[j] and len(usable[i]) == len(usable[j]):
                a, b = usable[i], usable[j]
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least:
                    pairs.append((i, j))
    comp = brute.components([i for i, _, _ in vecs], pairs)
    got = {r["vec_id"]: r for r in rows}
    assert len(rows) == len(vecs)
    for i in comp:
        assert got[i]["n_links"] == sum(i in p for p in pairs), i
        assert got[i]["component_id"] == comp[i]
        assert got[i]["kept"] == (comp[i] == i)
    return pairs


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("least", [0.98, 0.9])
def test_embedding_links_equal_brute_force(spark, least):
    v = vectors()
    assert check_links(embeddings.near_duplicates(spark.createDataFrame(v, SCHEMA), least).collect(), v, least)


def test_embedding_small_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    monkeypatch.setattr(embeddings, "TILE", 2)
    v = vectors(9)
    assert check_links(embeddings.near_duplicates(spark.createDataFrame(v, SCHEMA), 0.95).collect(), v, 0.95)


def test_embedding_odd_rows(spark):
    v = vectors(10)[:20]
    v += [(100, None, 1), (101, [], 1), (102, [0.0] * 12, 1), (103, [None] + [1.0] * 11, 1),
          (104, [float("nan")] + [1.0] * 11, 1), (105, [float("inf")] + [1.0] * 11, 1),
          (106, v[0][1], None), (107, v[0][1], 0), (108, v[0][1][:5], 0), (109, v[0][1][:5], 0),
          (110, [3.0], 2), (111, [5.0], 2), (112, [-5.0], 2)]
    d = spark.createDataFrame([r + ("x",) for r in v], SCHEMA + ", cls string")
    check_links(embeddings.near_duplicates(d).collect(), v, 0.98)
    assert embeddings.near_duplicates(d.limit(0)).count() == 0


def test_embedding_query(spark):
    rows = queries.QUERIES["op10_embedding_near_dup"](spark, SMALL).collect()
    d = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label")
    check_links(rows, [tuple(r) for r in d.collect()], 0.98)


def test_word_hashes_split_as_the_pattern(odd_rows):
    texts = [t for _, t, _ in odd_rows]
    raw, off = wd.text_buffers(pa.array(texts))
    h, start, end, first = wd.words(raw, off)
    own = [raw[a:b].tobytes().decode() for a, b in zip(start, end)]
    assert [own[first[i]:first[i + 1]] for i in range(len(texts))] == [brute.words(t) for t in texts]
    assert len(set(zip(own, h.tolist()))) == len(set(own)) == len(set(h.tolist()))


def shingles_of(text):
    raw, off = wd.text_buffers(pa.array([text]))
    return substrings.shingled(raw, off)


def minimum(text, salt):
    """The shingle that is the minimum of the whole text."""
    return int(np.argmin(substrings.order_hash(shingles_of(text)[0], salt)))


def window_of(text, shingle, salt, width=46):
    """The widest window in ``text`` around ``shingle`` (0: none)."""
    sh, start, stop = shingles_of(text)
    _, left, c, right = substrings.compact_windows(sh, start, stop, width, salt)
    return max([int(r - x) for x, m, r in zip(left, c, right) if sh[m] == shingle], default=0)


def lure(rng, passage, wider=0):
    """A text without the passage in which its minima under every hash have windows too."""
    out = []
    for salt in substrings._SALT:
        at = minimum(" ".join(passage), salt)
        shingle = shingles_of(" ".join(passage))[0][at]
        while True:
            around = [f"u{rng.randrange(10**6)}" for _ in range(260)]
            text = around[:130] + passage[at:at + 5] + around[130:]
            if window_of(" ".join(text), shingle, salt) > wider:
                break
        out += text
    return out


def test_groups_meet_their_earlier_documents_once(monkeypatch):
    """Whatever is made at once: all pairs of an open row and a row of an earlier document of the
    group, over the rounds each once."""
    rng = np.random.default_rng(8)
    n = 700
    anchor, near = np.sort(rng.integers(0, 3, n)), rng.integers(0, 4, n)
    doc, is_open = rng.integers(0, 60, n), rng.random(n) < 0.4
    want = sorted((i, j) for i in range(n) for j in range(n) if is_open[i] and near[i] and doc[i] > doc[j]
                  and anchor[i] == anchor[j] and near[i] == near[j])
    for size in (1, 50, 1 << 18):
        monkeypatch.setattr(substrings, "PAIRS", size)
        ranked, got, lo, hi, more = substrings.ranks(anchor, doc, near), [], 0, 4, True
        while more:
            more = False
            for i, j, again in substrings.meetings(ranked, is_open, lo, hi):
                got += zip(i.tolist(), j.tolist())
                more |= again
            lo, hi = hi, 4 * hi
        assert sorted(got) == want


def test_groups_of_the_nearer_neighbour_meet_whole():
    """Documents that share no shingle but the nearer neighbour meet too, however many they are,
    and windows that share more than one neighbour meet once."""
    n = 300
    doc = np.arange(n)
    nearer, farther = np.full(n, 7), np.where(doc % 3 == 0, 9, doc + 100)
    for ahead, behind in ((nearer, 0 * doc), (farther << 32 | nearer, nearer), (0 * doc, farther << 32 | nearer)):
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (0 * doc, doc, doc, ahead, behind, np.ones(n, dtype=bool))],
            ["anchor", "doc_id", "place", "ahead", "behind", "open"])
        got, lo, hi, more = [], 0, substrings.EARLIEST, True
        while more:
            more = False
            for out in substrings._meetings(lo, hi)(iter([batch])):
                rows = list(zip(*(out.column(k).to_pylist() for k in (0, 1))))
                more |= (None, None) in rows
                got += [r for r in rows if r[1] is not None]
            lo, hi = hi, 4 * hi
        assert sorted(got) == [(a, b) for a in range(n) for b in range(a)]


def test_near_copies_are_proposed_once_a_task(spark):
    """Nodes that meet in many trees: a task makes a pair of them once, and names every tree."""
    members = np.arange(100, dtype=np.uint64) << np.uint64(33)
    point = jaccard.points(members, np.array([0, 100]))[0].tobytes()
    nodes = spark.createDataFrame([(k, 100, point, None) for k in range(6)],
                                  "node long, n_shingles long, point binary, coarse binary")
    trees = spark.createDataFrame([(t, k, k) for t in range(60) for k in range(6)],
                                  "shingle long, node long, component long")
    tested = spark.createDataFrame([], "u long, v long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [tuple(r) for r in jaccard._tree_pairs(trees, nodes, tested, SIM).collect()]
    assert {r[0] for r in rows} == set(range(60))
    pairs = [r[1:] for r in rows if r[1] is not None]
    assert set(pairs) == {(u, v) for u in range(6) for v in range(u)}
    assert len(pairs) <= 15 * tasks and len(rows) <= 15 * tasks + 60


def met_windows(spark, texts):
    """``{(a, b): places}`` of the windows of ``texts`` that all meet in one round."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(tuple(r) for r in substrings._windows(df, 46, 36).collect())
    batch = pa.RecordBatch.from_arrays([*(pa.array(c) for c in zip(*rows)), pa.array([True] * len(rows))],
                                       ["anchor", "doc_id", "place", "ahead", "behind", "open"])
    met = {}
    for out in substrings._meetings(0, 10**6, 46)(iter([batch])):
        for a, b, x, y in zip(*(c.to_pylist() for c in out.columns)):
            met.setdefault((a, b), []).append((x, y))
    return met


def test_runs_of_one_word_do_not_meet_window_by_window(spark):
    """Texts that share nothing but one word again and again: none meets another where the run is
    too short for a passage, and once a hash function where it is not."""
    rng = random.Random(31)
    for n, most in ((30, 0), (40, substrings.HASHES)):
        texts = []
        for k in range(20):
            around = [f"u{k}x{rng.randrange(10**6)}" for _ in range(300)]
            texts.append(" ".join(around[:150] + ["the"] * n + around[150:]))
        met = met_windows(spark, texts)
        assert all(len(v) <= most for v in met.values()), n


def test_passages_of_runs_meet_whole(spark):
    """An exact repeat made of runs of one word, whatever stands around it (more of the same word
    too), lies in a common interval of windows that meet."""
    rng = random.Random(32)
    texts, at = [], []
    for k in range(150):
        passage = []
        while len(passage) < 50:
            passage += [f"p{k}x{rng.randrange(4)}"] * rng.choice((1, 2, 7, 13, 17, 25, 30, 34, 50))
        passage = passage[:50]
        for side in "ab":
            before, after = ([f"{side}{k}x{rng.randrange(9)}" for _ in range(rng.randrange(70))] for _ in range(2))
            before += passage[:1] * rng.choice((0, 0, 3, 40))
            after = passage[-1:] * rng.choice((0, 0, 3, 40)) + after
            texts.append(" ".join(before + passage + after))
            at.append(len(before))
    met = met_windows(spark, texts)
    for k in range(0, len(texts), 2):
        x, y = (np.array(c, dtype=np.int64) for c in zip(*met[k + 1, k]))
        runs = substrings.common_runs(x, y, np.array([0, len(x)]), 46)
        assert any(s <= at[k + 1] and s + n >= at[k + 1] + 46 and u <= at[k] and u + v >= at[k] + 46
                   for _, s, n, u, v in runs), texts[k:k + 2]


def test_copies_between_unrelated_first_and_last(spark):
    rng = random.Random(12)
    fresh = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(50)
    near = passage[:20] + ["changed"] + passage[21:]
    for second in (passage, near):
        texts = [lure(rng, passage), fresh(40) + passage + fresh(70), fresh(90) + second + fresh(9),
                 fresh(30) + lure(rng, passage)]
        rows = substrings.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()
        check_passages(rows, dict(enumerate(" ".join(t) for t in texts)), 50)
        if second is passage:
            assert {(r["doc_id"], r["match_doc_id"]) for r in rows} == {(2, 1)}


def test_passage_in_a_narrower_window_of_the_first_document(spark):
    rng = random.Random(13)
    fresh = lambda n: [f"g{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(50)
    wide = lure(rng, passage, wider=100)
    texts = [" ".join(t) for t in (passage + wide, fresh(60) + passage + fresh(5))]
    for salt in substrings._SALT:  # the passage's own window is not the widest
        shingle = shingles_of(" ".join(passage))[0][minimum(" ".join(passage), salt)]
        assert window_of(" ".join(passage), shingle, salt) < window_of(" ".join(wide), shingle, salt)
    rows = substrings.repeated_passages(frame(spark, texts)).collect()
    must, _ = check_passages(rows, dict(enumerate(texts)), 50)
    assert set(must) == {1}


def edited(words, rng):
    """A near copy: one word in every 50 is another."""
    out = list(words)
    for k in range(25, len(out), 50):
        out[k] = f"e{rng.randrange(10**6)}"
    return out


def covered_by(found, n):
    out = np.zeros(n, dtype=bool)
    for i, j, _, _, similar in found:
        assert similar >= 0.8 and j - i >= 46
        out[i:j] = True
    return out


def test_near_copies_that_lie_apart_or_in_other_order():
    rng = random.Random(14)
    fresh = lambda n: [f"h{rng.randrange(10**6)}" for _ in range(n)]
    p, q = fresh(100), fresh(100)
    for a, b in ((p + q, edited(p, rng) + fresh(300) + edited(q, rng)),
                 (p + q, edited(q, rng) + fresh(120) + edited(p, rng)),
                 (p + q, edited(p, rng)[:90] + fresh(150) + edited(p + q, rng)[90:]),
                 (p + q, p[:5] * 8 + fresh(300) + edited(p, rng) + fresh(300) + q[40:60] + edited(q, rng))):
        sa, sb = (shingles_of(" ".join(t))[0] for t in (a, b))
        found = substrings.passages(sa, sb, 46, 80, 100)
        for i, j, u, v, similar in found:
            x, y = set(sa[i:j].tolist()), set(sb[u:v].tolist())
            assert len(x & y) / len(x | y) == similar and v - u >= 46
        got = covered_by(found, len(sa))
        assert got.mean() >= 0.85, got.mean()


def test_one_line_many_times_in_both_is_bounded():
    sa, sb = (shingles_of(" ".join(["same"] * n))[0] for n in (9000, 60))
    mixed = np.concatenate([sb, np.arange(9000, dtype=np.uint64), sb])
    assert covered_by(substrings.by_diagonals(sa[:3000], mixed, 0, 3000, 46, 80, 100), 3000).any()


def test_common_runs_of_other_diagonals_stay_apart():
    place = lambda c: c << 2 * substrings.REACH | 40 << substrings.REACH | 40
    x, y = np.array([place(100), place(150), place(160)]), np.array([place(100), place(5000), place(170)])
    rows = substrings.common_runs(x, y, np.array([0, 3]), 46)
    assert rows == [(0, 60, 141, 60, 151), (0, 110, 81, 4960, 81)]


def test_one_of_each_of_rows_without_or_with_one_id(spark):
    rng = random.Random(15)
    fresh = lambda n: " ".join(f"n{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, d, e = (fresh(30) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (None, None), (None, ""), (1, c), (1, d), (1, d),
            (2, c), (3, e), (None, e), (4, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.one_of_each(docs, jaccard.Similarity(5, 80, 100)).collect()
    ids = lambda t: [r["doc_id"] for r in got if r["text"] in t]
    assert ids([a]) == [None] and ids([b]) == [None] and ids([c]) == [1]
    assert ids([d]) == [1] and ids([e]) == [3]
    assert sorted(map(str, ids(["", None]))) == ["4", "4", "None", "None"]
    assert len(got) == 9


def test_links_of_rows_without_an_id(spark):
    rng = random.Random(16)
    w = [f"m{rng.randrange(10**6)}" for _ in range(130)]
    rows = [(5, w[:100]), (None, w[8:108]), (7, w[16:116]), (None, w[:60] + ["x"]), (None, ["x"] + w[:60])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    sim = jaccard.Similarity(5, 80, 100)
    got = {r["text"]: r["component_id"] for r in docs.join(
        jaccard.jaccard_components(docs, sim).filter("doc_id IS NOT NULL"), "doc_id").collect()}
    assert set(got.values()) == {5}  # linked through the row without an id alone
    kept = sorted((r["doc_id"] or 0, r["text"].split()[0] == "x" or r["text"].split()[-1] == "x")
                  for r in jaccard.one_of_each(docs, sim).collect())
    assert kept == [(0, True), (5, False)]


def test_passage_beyond_the_8388608th_word(spark):
    rng = np.random.default_rng(17)
    before = " ".join(np.array([f"{i:03x}" for i in range(4096)])[rng.integers(0, 4096, 2**23 + 20)])
    passage = " ".join(f"z{i}" for i in range(60))
    rows = substrings.repeated_passages(frame(spark, [passage, f"{before} {passage}"])).collect()
    assert [(r["doc_id"], r["start_word"], r["n_words"], r["match_doc_id"]) for r in rows] == [
        (1, 2**23 + 20, 60, 0)]


def test_copies_of_one_passage_are_not_paired_all_with_all(spark):
    """A passage, or one word again and again, in many texts that share nothing else: each is
    compared with the first that has it and not with all others, and each is found."""
    rng = random.Random(41)
    fresh = lambda n: [f"q{rng.randrange(10**7)}" for _ in range(n)]
    passage = fresh(62)
    for own, short in ((passage, passage[:20]), (["again"] * 70, ["again"] * 12)):
        texts = [fresh(80) + short + fresh(80)]  # shares the anchors, not the passage
        texts += [fresh(rng.randrange(60, 120)) + own + fresh(rng.randrange(60, 120)) for _ in range(120)]
        rows = substrings.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()
        must, _ = check_passages(rows, dict(enumerate(" ".join(t) for t in texts)), 50)
        assert set(must) == set(range(2, 121))
        assert len(rows) <= 4 * len(texts)


def test_what_goes_on_beyond_a_known_passage_is_found(spark):
    """Texts that share a passage with the first one, and more of it with one another."""
    rng = random.Random(42)
    fresh = lambda n: [f"r{rng.randrange(10**7)}" for _ in range(n)]
    passage, more = fresh(70), fresh(30)
    changed = ["other"] + more[1:]
    for before, after in ((more, []), ([], more), (more[:-1] + ["other"], []), ([], changed)):
        longer = before + passage + after
        texts = [fresh(90) + passage + fresh(90)]
        texts += [fresh(90) + passage + fresh(90) for _ in range(40)]
        texts += [fresh(90) + (more + passage if before else passage + more) + fresh(90), fresh(70) + longer + fresh(80)]
        rows = substrings.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()
        check_passages(rows, dict(enumerate(" ".join(t) for t in texts)), 50)
        most = max(r["n_words"] for r in rows if (r["doc_id"], r["match_doc_id"]) == (42, 41))
        assert most >= 95, (most, len(before), len(after))


def test_what_cannot_be_similar_is_not_tried(monkeypatch):
    """A phrase again and again, with one word in it exchanged: no run of it is similar, which the
    shingles that the other text lacks show before any pair of runs is compared."""
    phrase = [f"s{k}" for k in range(30)]
    sa, sb = (shingles_of(" ".join(p * 40))[0] for p in (phrase, phrase[:12] + ["other"] + phrase[13:]))
    calls, of = [], substrings._Alike.of
    monkeypatch.setattr(substrings._Alike, "of", lambda self, *a: calls.append(a) or of(self, *a))
    assert substrings.by_diagonals(sa, sb, 0, len(sa), 46, 80, 100) == [] and not calls
    rng = np.random.default_rng(43)
    for _ in range(50):
        own, n, width = rng.integers(0, 9, 60), rng.integers(46, 60), 20
        mark = np.isin(own[:n], [1, 4, 7])
        want = [len(set(own[k:k + width][mark[k:k + width]].tolist())) for k in range(n - width + 1)]
        assert substrings.distinct_in_runs(own[:n], mark, width).tolist() == want


def test_texts_that_share_a_line_are_not_compared_all_with_all(spark, monkeypatch):
    """A line too short for a passage, in many texts: beyond the first of them only those are compared
    that share more around it, and these are all found."""
    rng = random.Random(44)
    fresh = lambda n: [f"v{rng.randrange(10**7)}" for _ in range(n)]
    line = fresh(18)
    passage = fresh(20) + line + fresh(20)
    texts = [fresh(rng.randrange(60, 90)) + (passage if k in (31, 37, 44) else line) + fresh(rng.randrange(60, 90))
             for k in range(45)]
    tested, run = [], substrings._tested
    monkeypatch.setattr(substrings, "EARLIEST", 2)
    monkeypatch.setattr(substrings, "_tested", lambda cuts, *a: tested.append(
        cuts.filter("b IS NOT NULL").count()) or run(cuts, *a))
    texts = [" ".join(t) for t in texts]
    rows = substrings.repeated_passages(frame(spark, texts)).collect()
    check_passages(rows, dict(enumerate(texts)), 50)
    assert {r["doc_id"] for r in rows} == {37, 44}
    assert len(tested) > 5 and sum(tested[4:]) <= 20, tested


def test_surroundings_of_windows(spark):
    text = " ".join(f"w{k}" for k in range(80))
    docs = spark.createDataFrame([(1, text), (1, "short"), (2, f"new {text}"), (None, text), (3, None)],
                                 "doc_id long, text string")
    left = spark.createDataFrame([(1, 30 << 32), (1, 0), (2, 31 << 32), (2, 3 << 32)], "doc_id long, place long")
    got = {(r["doc_id"], r["place"] >> 32): np.frombuffer(bytes(r["around"]), dtype=np.uint16)
           for r in substrings._surrounded(left, docs, 46).collect()}
    around = np.stack([got[k] for k in ((1, 30), (2, 31), (1, 0), (2, 3))])
    assert around.shape == (4, 93) and not around[2][:46].any() and around[2][46:].all()
    assert np.array_equal(around[0][16:], around[1][16:])
    i, j = np.array([0, 0, 0, 2]), np.array([1, 2, 3, 3])
    assert substrings.alike_around(around, i, j, 31).tolist() == [True, False, False, True]
    assert substrings.alike_around(around, i[:1], j[:1], 94).tolist() == [False]
