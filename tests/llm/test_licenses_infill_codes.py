"""License scan, fill-in-middle and vector codes against plain forms, SQL and odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import zstandard

from marketweave.llm import codes, infill, licenses, queries
from tests.conftest import SMALL
from tests.llm.brute import lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMALL)
    cur = con.execute(queries.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall())
    assert Counter(map(tuple, df.collect())) == want


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_fill_in_middle", "op13_vector_codes"])
def test_equals_sql(spark, name):
    against_sql(spark, name)


# --- license scan

def brute_scan(text, templates, phrases, share):
    """Every block compared with every template, every place with every phrase."""
    w = WORD.findall(lower(text))
    places = [(i, label) for label, p in phrases for q in [WORD.findall(lower(p))]
              for i in range(len(w) - len(q) + 1) if w[i:i + len(q)] == q]
    found = set()
    for label, t in templates:
        want = WORD.findall(lower(t))
        step = max(8, 1 << max(0, len(want) - 1).bit_length())
        for block in range(0, -(-len(w) // step)):
            shared = len(set(w[block * step:(block + 2) * step]) & set(want))
            if want and share[1] * shared >= share[0] * len(set(want)):
                found.add((label, block * step, shared, len(set(want))))
    base = {label for _, label in places}
    return {"n_words": len(w), "n_base": len(places),
            "first_word": min(places, default=(None,))[0], "last_word": max(places, default=(None,))[0],
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {f[0] for f in found})),
            "score": 1.0 if places else max((f[2] / f[3] for f in found), default=0.0),
            "blocks": sorted(found)}


def check_scan(rows, texts, templates=licenses.TEMPLATES, phrases=licenses.PHRASES, share=licenses.SHARE):
    got, want = [], []
    for r in rows:
        d = r.asDict(recursive=True)
        d["blocks"] = sorted({(b["label"], b["first_word"], b["shared"], b["size"]) for b in d["blocks"]})
        got.append(repr(sorted(d.items())))
    for i, t in texts:
        want.append(repr(sorted((brute_scan(t, templates, phrases, share) | {"doc_id": i}).items())))
    assert Counter(got) == Counter(want)


def test_scan_equals_brute_force(spark, documents):
    rng = np.random.Generator(np.random.PCG64(3))
    notices = [t for _, t in licenses.TEMPLATES] + [p for _, p in licenses.PHRASES]
    texts = [(i, t) for i, t, _ in documents[:60]]
    for i in range(240):  # notices with words dropped, swapped and put into prose of their own words
        w = notices[i % len(notices)].split()
        w = [x for x in w if rng.random() > 0.04 * (i % 4)]
        if i % 3 == 0:
            rng.shuffle(w)
        pad = [notices[j].split()[k % 3] for j, k in rng.integers(0, len(notices), (int(rng.integers(0, 60)), 2))]
        texts.append((1000 + i, " ".join(pad + w + pad[::-1])))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check_scan(licenses.scan(df).collect(), texts)


@pytest.mark.parametrize("share", [(1, 2), (4, 5), (1, 1)])
def test_scan_filters_lose_nothing(spark, share):
    """Few words, many overlaps: every threshold finds what all comparisons find."""
    rng = np.random.Generator(np.random.PCG64(share[0] * 10 + share[1]))
    some = [f"w{i}" for i in range(14)]
    templates = [(f"t{i}", " ".join(rng.choice(some, int(rng.integers(1, 24))))) for i in range(25)]
    texts = [(i, " ".join(rng.choice(some, int(rng.integers(0, 90))))) for i in range(80)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check_scan(licenses.scan(df, templates, (("p", "w1 w2"),), share).collect(), texts,
               templates, (("p", "w1 w2"),), share)


def test_scan_odd_rows(spark, odd_docs, odd_rows, no_docs):
    check_scan(licenses.scan(odd_docs).collect(), [(i, t) for i, t, _ in odd_rows])
    assert licenses.scan(no_docs).count() == 0
    # no word of a template anywhere, no templates at all
    plain = spark.createDataFrame([(1, "zzz"), (None, None)], "doc_id long, text string")
    check_scan(licenses.scan(plain).collect(), [(1, "zzz"), (None, None)])
    check_scan(licenses.scan(plain, (), ()).collect(), [(1, "zzz"), (None, None)], (), ())


def test_scan_reads_long_texts_in_pieces(spark, monkeypatch):
    text = "a\x00b " * 3000 + "Released UNDER the MIT-license. " + "é日本 " * 4000 + "CC BY-NC " * 2
    monkeypatch.setattr(licenses, "PIECE_BYTES", 1000)
    whole = licenses.Vocabulary.of(licenses.text_words("released under the mit license cc by nc"))
    raw = np.frombuffer(text.encode(), np.uint8)
    row, place, token, n = whole.places(raw, np.array([0, len(raw)]))
    words = WORD.findall(lower(text))
    assert n.tolist() == [len(words)]
    assert [(p, whole.names[t].decode()) for p, t in zip(place.tolist(), token.tolist())] == \
        [(i, w) for i, w in enumerate(words) if w.encode() in whole.names]


def test_scan_bounds_its_broadcast(no_docs):
    with pytest.raises(ValueError):
        licenses.scan(no_docs, [("x", "word " * (licenses.MAX_TEMPLATE_WORDS + 1))])


# --- fill in the middle

def brute_infill(doc_id, text, seed=1):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    pre, mid, suf = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return len(t), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("frame", [1, 7, 1 << 14])
def test_infill_equals_plain_form(spark, documents, odd_docs, odd_rows, no_docs, frame):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    extra = [(100_000 + i, t) for i, t in enumerate(
        ["<P>", "a<S>b", "<M", "<<P", "S>", "<P><", "x<", "<S", "\U0001F600<é>", "\x00\n"] * 4)]
    texts = [(i, t[:400] if t and frame < 99 else t) for i, t, _ in documents] + extra
    df = spark.createDataFrame(texts, "doc_id long, text string")
    out = infill.fill_in_middle(infill.store_frames(df, frame=frame))
    want = {i: brute_infill(i, t) for i, t in texts}
    rows = infill.with_texts(out).collect()
    assert {r["doc_id"]: (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
            for r in rows} == want
    assert {"plain", "psm", "spm"} == {r["form"] for r in rows}
    texts = dict(texts)
    for r in infill.with_digests(out).collect():
        assert r["output_sha256"] == sha(want[r["doc_id"]][-1])
        assert r["restored_sha256"] == sha(texts[r["doc_id"]] or "")
    if frame > 99:
        odd = infill.with_texts(infill.fill_in_middle(infill.store_frames(odd_docs))).collect()
        assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
                       for r in odd) == Counter((i, *brute_infill(i, t)) for i, t, _ in odd_rows)
        assert infill.with_digests(infill.fill_in_middle(infill.store_frames(no_docs))).count() == 0


def test_cut_frames_alone_are_opened():
    """Whole frames move as they are; two cuts open two frames at most."""
    text = "".join(chr(0x100 + i % 977) for i in range(10_000))
    stored, opened = infill.Frames.of(text, 100), []

    class Watched(infill.Frames):
        def open(self, k):
            opened.append(k)
            return super().open(k)

    form, a, b, out = infill.transform(Watched(stored.data, stored.ends), False, [1234, 7777, 0, 99])
    assert (form, a, b) == ("psm", 1234, 7777 - 1234)
    assert set(opened) == {12, 77}
    assert len(set(stored.data) & set(out.data)) == 98
    # the frames one after another are one zstandard stream
    with zstandard.ZstdDecompressor().stream_reader(b"".join(out.data), read_across_frames=True) as f:
        assert f.read().decode() == f"<P>{text[:1234]}<S>{text[7777:]}<M>{text[1234:7777]}"
    assert "".join(stored.stream(95, 305)) == text[95:305]
    assert stored.find(text[195:205], 3) == text.find(text[195:205], 3)


# --- vector codes

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Plain Lloyd rounds over Python integers; ``rows`` are (vec_id, label, vector)."""
    fine = [r for r in rows if r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    order = sorted(fine, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = next(len(r[2]) for r in order if r[2] and len(r[2]) % parts == 0)
    order = [r for r in order if len(r[2]) == dim]
    w = dim // parts
    q = [[int(np.floor(np.float64(x) * 1024)) for x in r[2]] for r in order]
    cut = [[tuple(v[k * w:(k + 1) * w]) for v in q] for k in range(parts)]
    books = [c[:entries] for c in cut]

    def nearest(p, book):
        return min((sum((x - y) ** 2 for x, y in zip(p, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            own = defaultdict(list)
            for p in cut[k]:
                own[nearest(p, books[k])[1]].append(p)
            books[k] = [tuple(sum(x) // len(own[i]) for x in zip(*own[i])) if i in own else e
                        for i, e in enumerate(books[k])]
    out = []
    for i, r in enumerate(order):
        near = [nearest(cut[k][i], books[k]) for k in range(parts)]
        out.append((r[0], r[1], "".join(f"{e:02x}" for _, e in near),
                    min(codes.LONG, sum(d for d, _ in near))))
    return out, books


def check_codes(spark, rows, kind="float", **how):
    df = spark.createDataFrame([(*r, "z") for r in rows],
                               f"vec_id long, label int, embedding array<{kind}>, code string")
    found, books = codes.compress(df, **how)
    how.pop("chunk", None)
    want, want_books = brute_codes(rows, **how)
    assert Counter(tuple(r) for r in found.collect()) == Counter(want)
    assert [[tuple(int(x) for x in e) for e in b] for b in books] == want_books
    total = defaultdict(int)
    for r in want:
        total[r[1]] += r[3]
    assert all(r["label_error"] == min(codes.LONG, total[r["label"]]) for r in codes.with_label_error(found).collect())


def test_codes_equal_brute_force(spark):
    """Clusters, repeated vectors, ties on a coarse grid; several trees a partition."""
    rng = np.random.Generator(np.random.PCG64(5))
    centres = rng.normal(size=(6, 8))
    rows = [(i, i % 3, (centres[i % 6] + rng.normal(size=8) * 0.02).astype(np.float32).tolist())
            for i in range(700)]
    rows += [(1000 + i, None, rows[7][2]) for i in range(300)]
    rows += [(2000 + i, 1, (rng.integers(-2, 3, 8) / 1024).tolist()) for i in range(300)]
    check_codes(spark, rows, entries=20, chunk=100)
    check_codes(spark, rows[:50] + rows[1000:1040], rounds=2)


def test_codes_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.5, 0.25, 3.0]), (1, 1, [0.5, -0.5, 0.25, 3.0]), (1, 2, [0.1, 0.2, 0.3, 0.4]),
            (2, None, None), (3, None, [0.1, None, 0.2, 0.3]), (4, 1, [nan, 0.0, 0.0, 0.0]),
            (5, 1, [inf, 0.0, 0.0, 0.0]), (6, 1, []), (7, 1, [1.0, 2.0, 3.0]), (8, 1, [0.1] * 8),
            (None, None, [0.0, 0.0, 0.0, 0.0]), (None, 3, [-0.0, -1e-9, 0.0, 7.0]), (9, None, [1e5] * 4)]
    check_codes(spark, rows, kind="double")
    check_codes(spark, rows, kind="double", entries=2)
    huge = [(i, 1, [1e9 * (i % 5), -1e9, i / 7, 0.0]) for i in range(12)]
    check_codes(spark, huge, kind="double", entries=3, rounds=1)
    empty = spark.createDataFrame(rows[3:7], "vec_id long, label int, embedding array<double>")
    found, books = codes.compress(empty)
    assert (found.count(), books) == (0, [])
    assert codes.with_label_error(found).count() == 0
    past = spark.createDataFrame([(1, 1, [1e300, 0.0, 0.0, 0.0]), (2, 1, [-1e300, 0.0, 0.0, 0.0])],
                                 "vec_id long, label int, embedding array<double>")
    assert [r["error"] for r in codes.compress(past, entries=1)[0].orderBy("vec_id").collect()][1] > 0


def test_tree_covers_and_prunes():
    rng = np.random.Generator(np.random.PCG64(8))
    centres = rng.integers(-4000, 4000, (12, 6))
    points = centres[rng.integers(0, 12, 3000)] + rng.integers(-30, 30, (3000, 6))
    t = codes.CoverTree.build(points)
    assert sorted(t.order.tolist()) == list(range(3000))
    for i in range(len(t.lo)):
        own = t.order[t.lo[i]:t.hi[i]]
        assert t.centre[i] in own
        d = np.sqrt(((points[own] - points[t.centre[i]]) ** 2).sum(1))
        assert d.max() <= t.radius[i] * codes.MARGIN
        if t.fan[i]:
            c = np.arange(t.child[i], t.child[i] + t.fan[i])
            assert (t.lo[c[0]], t.hi[c[-1]]) == (t.lo[i], t.hi[i])
            assert (t.lo[c[1:]] == t.hi[c[:-1]]).all()
    lo, hi, best = t.assign(points, centres)
    got = np.empty(3000, int)
    got[t.order[codes._spans(lo, hi - lo)]] = np.repeat(best, hi - lo)
    assert (got == ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)).all()
    assert len(lo) < 300  # most points go in whole subtrees
    n, s = codes.part_sums(points, t, centres)
    assert (n == np.bincount(got, minlength=12)).all()
    assert (s == np.stack([points[got == e].sum(0) for e in range(12)])).all()
