"""Merkle manifests against a plain tree."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from orthoweave.llm import merkle

from .conftest import DOCS, sentence


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def way_up(levels, at, folded):
    siblings = []
    for level in levels[:-1]:
        begin = at - at % 16
        run = level[begin:begin + 16]
        siblings += run[:at - begin] + run[at - begin + 1:]
        folded = h(*run[:at - begin], folded, *run[at - begin + 1:])
        at //= 16
    return siblings, folded


def plain_rows(docs):
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    sources = defaultdict(list)
    for r in docs:
        leaf = h(*[field(r[c]) for c in merkle.FIELDS])
        changed = None if r.text is None else r.text.translate(lower)
        marked = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0
        start = h(*[field(r[c]) for c in merkle.FIELDS[:4]], field(changed)) if marked else leaf
        sources[r.source].append((r.doc_id, leaf, start))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = plain_levels([leaf for _, leaf, _ in sources[s]])
    top = plain_levels([trees[s][-1][0] for s in order]) if order else []
    out = []
    for k, s in enumerate(order):
        for i, (doc_id, leaf, start) in enumerate(sources[s]):
            below, folded = way_up(trees[s], i, start)
            above, folded = way_up(top, k, folded)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[s][-1][0], root, "".join(below + above), folded, folded == root))
    return out


def rows(docs):
    return Counter(map(tuple, merkle.prove(docs).collect()))


def many(spark, rng, sizes):
    data, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            data.append((i * 7919 % 100_003, sentence(rng, 3), "en", source, i))
    return spark.createDataFrame(data, DOCS)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 17}, {"a": 1, "b": 1}, {None: 16, "é": 256, "z": 257, "Z": 2},
    {f"s{k}": 1 + k % 3 for k in range(40)}, {"hot": 4500, "b": 5}])
def test_against_a_plain_tree(spark, rng, sizes):
    docs = many(spark, rng, sizes)
    found = rows(docs)
    assert found == Counter(plain_rows(docs.collect()))
    assert {r[6] for r in found} <= {True, False} and any(r[6] for r in found) or len(found) == 1


def test_awkward_rows(spark, awkward, clashing, empty):
    plain = Counter(plain_rows(awkward.collect()))
    assert rows(awkward) == plain and rows(clashing) == plain
    assert merkle.prove(empty).collect() == []
    changed = [r for r in plain if not r[6]]
    assert changed and all(r[5] != r[3] for r in changed)


def test_blocks_of_upper_nodes(spark, rng, monkeypatch):
    """Blocks of 16 leaves: upper nodes are stored per block and nothing changes."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    docs = many(spark, rng, {"a": 700, "b": 20, "c": 1, **{f"s{k}": 1 for k in range(20)}})
    assert rows(docs) == Counter(plain_rows(docs.collect()))


def test_nodes_link_to_their_parents(spark, rng):
    docs = many(spark, rng, {"a": 300, "b": 20})
    _, nodes = merkle.manifest(docs)
    found = {(r.tree, r.level, r.idx): r for r in nodes.collect()}
    for r in found.values():
        if r.up_tree is None:
            assert (r.tree, r.level) == (merkle.TOP, 1)
        else:
            up = found[r.up_tree, r.up_level, r.up_idx]
            assert bytes(up.run[32 * r.position:32 * r.position + 32]) == bytes(r.hash)
