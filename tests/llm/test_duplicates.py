import hashlib
import random
from collections import Counter

import numpy as np
from frames import empty, messy, messy_rows, prose, rows_of, shingles_of, words_of

from barwatch.llm import embedding_dedup
from barwatch.llm.embedding_dedup import embedding_links, full_counts
from barwatch.llm.near_dedup import alignment, drop_near, near_classes
from barwatch.llm.substring_dedup import COVER, PERIOD, drop_passages, repeated_passages


def connected(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def expected_passages(rows):
    seen, out = {}, Counter()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for r in order:
        w = words_of(r[1])
        for i in range(len(w) - 49):
            seen.setdefault(tuple(w[i : i + 50]), r[0])
    for r in order:
        w = words_of(r[1])
        keep = [True] * len(w)
        for i in range(len(w) - 49):
            first = seen[tuple(w[i : i + 50])]
            if first is not None and (r[0] is None or first < r[0]):
                keep[i : i + 50] = [False] * 50
        kept = " ".join(x for x, k in zip(w, keep) if k)
        out[r[0], len(w), keep.count(False), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_repeated_passages_of_messy_rows(spark):
    found = repeated_passages(messy(spark))
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected_passages(messy_rows())
    assert repeated_passages(empty(spark)).count() == 0


def test_passages_at_every_shift(spark):
    rng = random.Random(8)
    passage = prose(rng, 50)
    rows = [(i, f"{prose(rng, i)} {passage} {prose(rng, 5)}") for i in range(0, 70, 3)]
    rows += [(100 + i, f"{passage[:-9 - i]} cut {prose(rng, 40)}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages(docs)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected_passages(rows)


def test_drop_passages_keeps_columns_and_clean_rows(spark):
    docs = messy(spark)
    out = drop_passages(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[6] == 0 and ids[7] == ids[8] == 1 and ids[3] == 3
    assert drop_passages(empty(spark)).count() == 0


def test_alignment_against_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randint(0, 30) for _ in range(rng.randint(1, 40))]
        b = [x for x in a if rng.random() > 0.06] + [rng.randint(0, 30) for _ in range(rng.randint(0, 3))]
        if not b:
            continue
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        m = table[-1][-1]
        true = m / (len(a) + len(b) - m)
        assert alignment(a, b) == true if true >= 0.8 else alignment(a, b) < 0.8


def test_near_classes_against_all_pairs(spark):
    rng = random.Random(6)
    rows = [(r[0], r[1]) for r in messy_rows()]
    base = prose(rng, 200).split()
    for i in range(100, 130):
        some = list(base)
        for _ in range(rng.choice([1, 3, 6, 20])):
            some[rng.randrange(len(some))] = prose(rng, 1) + "x"
        rows.append((i, " ".join(some)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = list(range(len(rows)))
    sets = [shingles_of(t) for _, t in rows]
    linked = []
    for i in names:
        for j in range(i):
            common = sum((sets[i] & sets[j]).values())
            if common and common >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - common):
                linked.append((i, j))
    roots = connected(names, linked)
    least = {}
    for i in names:
        if rows[i][0] is not None:
            least[roots[i]] = min(least.get(roots[i], 10**9), rows[i][0])
    size = Counter(roots.values())
    want = Counter((rows[i][0], least.get(roots[i]), size[roots[i]]) for i in names)
    assert rows_of(near_classes(docs), "doc_id", "class_id", "class_size") == want
    kept = drop_near(messy(spark))
    assert kept.columns == messy(spark).columns
    assert len({r.doc_id for r in kept.collect()} & {0, 1, 2}) == 1
    assert near_classes(empty(spark)).count() == 0 and drop_near(empty(spark)).count() == 0


def vectors():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(150)]
    rows += [(200 + i, (centre + rng.normal(size=16) * 0.12).tolist()) for i in range(60)]
    rows += [(300 + i, rows[3][1]) for i in range(20)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16)]
    rows += [(405, [float("inf")] + [1.0] * 15), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (None, rows[5][1]), rows[7]]
    return rows


def expected_links(rows):
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    names, linked = list(range(len(rows))), []
    for i in names:
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if usable(a) and usable(b) and len(a) == len(b):
                a, b = np.array(a), np.array(b)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    linked.append((i, j))
    roots = connected(names, linked)
    degree = Counter(i for pair in linked for i in pair)
    least = {}
    for i in names:
        if rows[i][0] is not None:
            least[roots[i]] = min(least.get(roots[i], 10**9), rows[i][0])
    return Counter((rows[i][0], degree[i], least.get(roots[i]), rows[i][0] == least.get(roots[i])) for i in names)


def test_links_against_all_pairs(spark):
    rows = vectors()
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, label int, _vec string")
    assert rows_of(embedding_links(table), "vec_id", "n_links", "component_id", "kept") == expected_links(rows)
    assert embedding_links(table.limit(0)).count() == 0


def test_full_counts_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    rng = np.random.default_rng(3)
    x = np.ones((150, 8)) + rng.normal(size=(150, 8)) * np.linspace(0.01, 0.5, 150)[:, None]
    table = spark.createDataFrame([(0, i, v.tolist(), 1 + i % 3) for i, v in enumerate(x)], "root long, _row long, _vec array<double>, _copies long")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95) @ (1 + np.arange(150) % 3)
    assert {r._row: r._n for r in full_counts(table).collect()} == dict(enumerate(want.tolist()))


def test_links_between_saturated_groups(spark):
    rng = np.random.default_rng(7)
    axes = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    x = [axes[0] + rng.normal(size=16) * 0.01 for _ in range(40)]
    x += [0.96 * axes[0] + 0.28 * axes[1] + rng.normal(size=16) * 0.01 for _ in range(30)]
    x += [axes[0] - 0.25 * axes[2] + rng.normal(size=16) * 0.02 for _ in range(25)]
    x += [axes[5] + rng.normal(size=16) * 0.01 for _ in range(30)]
    x += [axes[3] + rng.normal(size=16) * 0.4 for _ in range(40)]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x)] + [(900, x[0].tolist()), (901, x[50].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = rows_of(embedding_links(table), "vec_id", "n_links", "component_id", "kept")
    assert found == expected_links(rows)


def test_guests_of_a_component(spark):
    x = np.eye(8)[[0] * 20 + [0, 1, 2]] + np.random.default_rng(2).normal(size=(23, 8)) * 0.02
    x[20] += 0.28 * np.eye(8)[3]
    frame = spark.createDataFrame(
        [(i, v.tolist(), 1 + i % 2, 0 if i < 20 else i, i < 20) for i, v in enumerate(x)],
        "_row long, _vec array<double>, _copies long, _root long, _full boolean",
    )
    members = frame.filter("_full").select(frame["_root"].alias("root"), "_row", "_vec", "_copies")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    near[20:, 20:] = False
    want = {i: n for i, n in enumerate((near @ (1 + np.arange(23) % 2)).tolist()) if n}
    assert {r._row: r._n for r in embedding_dedup.full_counts(members, frame).collect() if r._n} == want
    assert 20 in want and 21 not in want


def test_audit_sees_sparse_vectors_beside_full_lists(spark):
    rng = np.random.default_rng(5)
    hot = np.ones(16) + rng.normal(size=(52, 16)) * 0.01
    lone = np.repeat(rng.normal(size=(2, 16)), 2, axis=0) + rng.normal(size=(4, 16)) * 0.01
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([hot, lone]))], "_row long, _vec array<double>")
    edges = [(i, (i + j) % 52, 0.99) for i in range(52) for j in range(1, 11)]
    held = [(a, a ^ 1, 0.99) for a in range(52, 56)]
    for extra, want in (([], 0.0), (held[:2], 0.5), (held, 1.0)):
        graph = spark.createDataFrame(edges + extra, "a long, b long, s double")
        assert embedding_dedup.audited_recall(graph, nodes, 10) == want


def test_links_are_whole_where_descent_fails(spark, monkeypatch):
    for name, value in (("TREES", 1), ("LEAF", 2), ("ROUNDS", 0), ("ENLARGED", 0), ("BLOCK", 50)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(11)
    pairs = np.repeat(rng.normal(size=(60, 16)), 2, axis=0) + rng.normal(size=(120, 16)) * 0.12
    rows = [(i, v.tolist()) for i, v in enumerate(pairs)] + [(500 + i, [1.0 + i, 2.0]) for i in range(3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(embedding_links(table), "vec_id", "n_links", "component_id", "kept") == expected_links(rows)


def test_alignment_of_contained_sequences_at_the_threshold():
    for t in range(1, 400):
        assert alignment(list(range(4 * t)), list(range(5 * t))) == 0.8
        assert alignment(list(range(4 * t)), list(range(5 * t + 1))) < 0.8


def test_texts_a_quarter_longer_are_near(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[: n + 4])) for i, n in enumerate((28, 35))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in near_classes(docs).collect()} == {0}


def test_short_texts_are_never_missed(spark):
    rng = random.Random(12)
    texts = []
    for n in list(range(5, 45)) * 2:
        some = [f"{n}-{rng.random()}" for _ in range(n)]
        shingles = max(1, n - 4)
        texts += [some, some + ["x"] * (shingles // 4), ["y"] * (shingles // 4) + some]
    texts += [["all", "of", "it", "is", "here", f"t{i}", "and", "there"] for i in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [shingles_of(t) for _, t in rows]
    linked = []
    for i in range(len(rows)):
        for j in range(i):
            common = sum((sets[i] & sets[j]).values())
            if 9 * common >= 4 * (sum(sets[i].values()) + sum(sets[j].values())):
                linked.append((i, j))
    want = connected(range(len(rows)), linked)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_classes(docs).collect()} == want
