import random
import re

import xxhash

from pagetables.llm import queries, simhash
from pagetables.llm.components import components

DATA = "/root/testdata/sf0.001"


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Smallest id reachable, by comparing all."""
    label = {k: k for k in range(len(prints))}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, (_, x) in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j][1]).bit_count() <= 3:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, _) in enumerate(prints):
        least.setdefault(root(k), []).append(doc)
    return [(doc, min((d for d in least[root(k)] if d is not None), default=None)) for k, (doc, _) in enumerate(prints)]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    prints = [(d, fingerprint(t)) for d, t in docs]
    want = {(d, f"{p:016x}", c) for (d, p), (_, c) in zip(prints, brute(prints))}
    got = queries.op7_simhash(spark, DATA).select("doc_id", "fingerprint", "component_id").collect()
    assert len(got) == len(docs) and set(map(tuple, got)) == want


def test_odd_rows(spark, documents, no_documents):
    rows = [(r.doc_id, fingerprint(r.text)) for r in documents.collect()]
    got = sorted(((str(r.doc_id), r.component_id) for r in simhash.near_groups(documents).collect()), key=str)
    assert got == sorted(((str(d), c) for d, c in brute(rows)), key=str)
    assert simhash.near_groups(no_documents).count() == 0
    kept = simhash.drop_near_copies(documents)
    assert kept.columns == documents.columns
    # ids 1, 2 and 2 again; 3, 4, 8 and no id; 5 and 6; the rest alone, with id 7 twice
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "None", "5", "7", "7", "9", "10"])


def test_covering_masks_miss_no_pair():
    draw = random.Random(0)
    for level in range(len(simhash.LEVELS)):
        masks = simhash.masks(level)
        assert len(masks) == 15 and all(masks)
        for _ in range(2000):
            bits = draw.sample(range(64), 3)
            assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_last_buckets_are_bounded():
    maps = simhash.LEVELS
    open_ = [0]
    dot = lambda x, v: (x & v).bit_count() % 2
    worst = 0
    for a in range(1, 16):
        left_a = [i for i in range(64) if not dot(maps[0][i], a)]
        for b in range(1, 16):
            left_b = [i for i in left_a if not dot(maps[1][i], b)]
            for c in range(1, 16):
                left_c = [i for i in left_b if not dot(maps[2][i], c)]
                worst = max(worst, *(sum(not dot(maps[3][i], d) for i in left_c) for d in range(1, 16)))
    assert worst <= 12, open_


def test_crowded_buckets_go_through_all_levels(spark):
    """Thousands of fingerprints around a few centres; a bucket limit of 4 sends them down every level."""
    draw = random.Random(5)
    prints = set()
    for _ in range(3):
        centre = draw.getrandbits(64)
        for _ in range(120):
            x = centre
            for b in draw.sample(range(64), draw.randint(0, 6)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    edges = simhash.links(rows, simhash.SimHashParams(bucket=4))
    roots = {r.node: r.root for r in components(edges).collect()}
    signed = [r.fingerprint for r in rows.collect()]
    pairs = {}
    for (k, (_, c)), s in zip(enumerate(brute(list(enumerate(p % (1 << 64) for p in signed)))), signed):
        pairs.setdefault(c, set()).add(roots.get(s, s))
    assert all(len(v) == 1 for v in pairs.values()) and len({next(iter(v)) for v in pairs.values()}) == len(pairs)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {k: 0 for k in range(201)} | {500: 500, 501: 500}
