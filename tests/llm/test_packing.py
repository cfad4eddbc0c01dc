import random
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from tidewright.llm import bpe, packing


def test_scores_against_the_formula():
    r = random.Random(1)
    docs = sorted(([r.randrange(30) for _ in range(r.randint(1, 40))] for _ in range(25)), key=len)
    df = np.array([sum(t in d for d in docs) for t in range(30)], float)
    idf = np.log(1 + (25 - df + 0.5) / (df + 0.5))
    mean = np.mean([len(d) for d in docs])
    both = [np.unique(d, return_counts=True) for d in docs]
    sizes = np.array([len(d) for d in docs])
    index = packing.Index(np.concatenate([t for t, _ in both]), np.concatenate([c for _, c in both]), np.array([len(t) for t, _ in both]), sizes, idf, mean)
    for q in range(25):
        want = np.array([sum(idf[t] * d.count(t) * (packing.K1 + 1) / (d.count(t) + packing.K1 * (1 - packing.B + packing.B * len(d) / mean)) for t in set(docs[q]) if t in d) for d in docs])
        assert np.allclose(index.scores(both[q][0], 25), want, rtol=1e-5)
        assert np.allclose(index.exact(both[q][0], np.arange(25)), want, rtol=1e-5)
        fit = int((sizes <= 20).sum())
        near, score = index.nearest(both[q][0], 20, 5)
        assert np.allclose(score, np.sort(want[:fit])[::-1][:5], atol=1e-3) and np.allclose(want[near], score, atol=1e-3)


def test_matching_and_filling_up(spark):
    r = random.Random(2)
    edges = [(s, s * 7, 500, i, i * 3, r.randint(50, 400), float(r.randint(1, 50))) for s in range(30) for i in range(100, 180) if r.random() < 0.2]
    size = {i: r.randint(50, 400) for i in range(100, 180)}
    edges = [(s, a, room, i, b, size[i], x) for s, a, room, i, b, _, x in edges]
    df = spark.createDataFrame(edges, "seed long, sord long, room int, item long, iord long, size int, score double")
    taken = packing.match(df, 3)[0].collect()
    assert len({x.item for x in taken}) == len(taken)
    room = {s: 500 for s in range(30)}
    for x in taken:
        room[x.seed] -= x.size
    assert min(room.values()) >= 0
    for i in range(100, 180):  # the best edge of all is never refused
        if edges and max(edges, key=lambda e: (e[6], e[1]))[3] == i:
            assert any(x.item == i for x in taken)
    seeds = spark.createDataFrame([(s, s, 0, 500) for s in range(30)], "id long, ord long, copy long, size int")
    given = {x.item for x in taken}
    near = spark.createDataFrame([(x.item, x.iord, x.size, x.seed, k) for k, x in enumerate(taken)], "id long, ord long, size int, seed long, place int")
    left = {i: n for i, n in size.items() if i not in given} | {500 + k: 0 for k in range(9)}
    items = spark.createDataFrame([(i, i, 0, n) for i, n in left.items()], "id long, ord long, copy long, size int")
    laid = packing.fill_up(seeds, near, items, 1000, 1).collect()
    assert sorted(x.id for x in laid) == sorted([*range(30), *given, *left])
    used, places = Counter(), {}
    for x in laid:
        used[x.container] += 500 if x.id < 30 else size.get(x.id, 0)
        places.setdefault(x.container, []).append(x.place)
    assert max(used.values()) <= 1000 and all(sorted(p) == list(range(len(p))) for p in places.values())


def test_containers_that_neighbours_leave_too_empty_are_packed_again():
    r = random.Random(4)
    sizes = np.array(r.sample([40, 60, 55, 45] * 100, 400))  # they pair up
    content = [[i] for i in range(300)]  # far more containers than it takes
    boxes = packing.laid_out(content, sizes, np.arange(300, 400), 100)
    assert sorted(i for b in boxes for i in b) == list(range(400))
    assert max(sizes[b].sum() for b in boxes) <= 100 and len(boxes) <= -(-sizes.sum() // (packing.FULL * 100))
    snug = [[i, i + 1] for i in range(0, 10, 2)]
    assert packing.laid_out(snug, np.array([60, 40] * 5), np.zeros(0, int), 100) == snug  # what is full stays
    assert packing.laid_out([], np.zeros(0, int), np.zeros(0, int), 100) == []


def test_operator(spark):
    r = random.Random(3)
    texts = [None, "", "x " * 5000, *[" ".join(r.choice(["alpha", "beta", "gamma", "delta()", "9"]) for _ in range(r.randint(1, 180))) for _ in range(400)]]
    texts.append(texts[5])
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, place string").repartition(3)
    got = packing.pack(df, "doc_id", "text", capacity=256, postings=2000).collect()
    t = Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    n = {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}
    by_doc, by_box = {}, {}
    for x in got:
        by_doc.setdefault(x.doc_id, []).append(x)
        by_box.setdefault(x.container, []).append(x)
    assert by_doc.keys() == n.keys()
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda x: x.piece)
        assert [p.piece for p in pieces] == list(range(max(1, -(-n[i] // 256))))
        assert sum(p.tokens for p in pieces) == n[i] and [p.first for p in pieces] == [256 * k for k in range(len(pieces))]
    for box in by_box.values():
        assert sum(x.tokens for x in box) <= 256 and sorted(x.place for x in box) == list(range(len(box)))
    assert sum(n.values()) / (256 * len(by_box)) > 0.93
    assert packing.pack(df.limit(0), "doc_id", "text").collect() == []
