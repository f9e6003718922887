import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from pagetables.llm import conversations as C
from pagetables.llm import queries

DATA = "/root/testdata/sf0.001"


def said(role, text):
    return role or "", text or ""


def digest(pair):
    return hashlib.sha256(f"{len(pair[0])}:{pair[0]}{pair[1]}".encode()).hexdigest()


def sequences(rows):
    """Conversations as lists of (role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, digest(said(role, text)), said(role, text)))
    return {c: [x[-1] for x in sorted(v)] for c, v in found.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        todo, out = [node], []
        while todo:
            x = todo.pop()
            out.append(x)
            todo += children[x]
        return out

    rows = []
    for node, own in members.items():
        under = below(node)
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in under if x)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        rows.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
                     sum(not children[x] for x in under), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def same(df, want):
    assert sorted(map(str, (tuple(r) for r in df.select(*NAMES).collect()))) == sorted(map(str, want))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    query = queries.op13_conversation_trie(spark, DATA)
    same(query, brute(rebuilt(sequences(rows))))
    assert dict(query.dtypes) == {c: "bigint" for c in NAMES[:-1]} | {"ends_sha256": "string"}


@pytest.fixture(scope="module")
def talks(spark):
    """Copies, shared beginnings, conversations that are beginnings of others, long ones, and every oddity."""
    draw = random.Random(2)
    rows = []
    for c in range(120):
        kind = draw.randrange(4)
        n = draw.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, t, "user" if t % 2 == 0 else "bot", f"text {t} of {kind if t < 4 else draw.randrange(3)}") for t in range(n)]
    rows += [(1000, t, "user", "again and again") for t in range(230)]
    rows += [(1003, t, "user", "again and again") for t in range(200)]
    rows += [(500, 0, "a", "same")] * 3 + [(500, None, "a", None), (500, None, None, "x"), (500, 0, None, None)]
    rows += [(-3, 1, "u", "less than none"), (-25, 1, "u", "less"), (None, 1, "u", "of nobody"), (None, None, None, None)]
    rows += [(701, None, None, None), (702, 0, "", ""), (703, 0, "ab", "c"), (704, 0, "a", "bc")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "turn AS place", "role AS words", "text AS depth")


@pytest.mark.parametrize("params", [
    C.TrieParams(), C.TrieParams(stretch=7, part_bytes=4000, chunk=3, crowd=1),
], ids=["default", "small parts"])
def test_odd_rows(spark, talks, params):
    rows = talks.select("conv_id", "turn", "role", "text").collect()
    own = sequences(rows)
    turns = C.turn_rows(talks, params)
    same(C.trie(*C.shared_heads(turns), params), brute(rebuilt(own)))
    nodes = C.trie(*C.own_turns(turns), params)
    same(nodes, brute(own))
    texts = {(r.conv_id, r.depth): (r.role, r.text) for r in C.node_texts(nodes, turns, talks).collect()}
    want = {(min(c for c in own if own[c][:d] == own[k][:d]), d): own[k][d - 1] for k in (1, 500, 1000, 703) for d in range(1, len(own[k]) + 1)}
    assert all(texts[k] == v for k, v in want.items())


def test_no_rows(spark, talks):
    none = talks.where("false")
    assert C.trie(*C.shared_heads(C.turn_rows(none))).count() == 0
    assert C.trie(*C.own_turns(C.turn_rows(talks.where("conv_id IS NULL")))).count() == 0


def test_conversations_without_turns(spark):
    """Ids whose base is absent may lose all their turns; they are members of the root alone."""
    ids = [c for c in range(1, 400) if c > 20 and c % 20 and zlib.crc32(str(c).encode()) % 4][:5]
    rows = [(c, 0, "u", "gone") for c in ids]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute(rebuilt(sequences(rows)))
    assert len(want) == 1 and want[0][5] == 1
    same(C.trie(*C.shared_heads(C.turn_rows(table))), want)
