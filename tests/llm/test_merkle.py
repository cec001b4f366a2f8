import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from quillprep.llm.merkle import MerkleParams, Parent, Tile, field, folded, leaf, manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(nodes, k):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][at : at + k]) for at in range(0, len(out[-1]), k)])
    return out


def climb(tree, at, value, k):
    proof = []
    for nodes in tree[:-1]:
        first = at // k * k
        run = nodes[first : first + k]
        proof += run[: at - first] + run[at - first + 1 :]
        run[at - first] = value
        value, at = h(*run), at // k
    return value, proof


def brute(rows, k):
    """(id, leaf, subroot, root, digest of the proof, folded root) of (id, scope, leaf, claimed)."""
    scopes = sorted({s for _, s, _, _ in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for s in scopes}
    trees = {s: levels([r[2] for r in groups[s]], k) for s in scopes}
    top = levels([trees[s][-1][0] for s in scopes], k)
    out = []
    for n, s in enumerate(scopes):
        for at, (d, _, own, claimed) in enumerate(groups[s]):
            low, proof = climb(trees[s], at, claimed, k)
            high, more = climb(top, n, low, k)
            out.append((d, own, trees[s][-1][0], top[-1][0], h(*proof, *more), high))
    return sorted(out, key=str)


def test_parent_resumes_its_states():
    children = [h(str(i)).encode() for i in range(5)]
    parent = Parent([*children])
    assert parent.digest.decode() == h(*[c.decode() for c in children]) and len(parent.states) == 5
    for slot in range(5):
        changed = [*children]
        changed[slot] = h("other").encode()
        parent.children[:slot] = [b""] * slot  # what lies to the left is not read again
        assert parent.replaced(slot, changed[slot]).decode() == h(*[c.decode() for c in changed])
        parent.children[:slot] = children[:slot]


@pytest.mark.parametrize("k", [2, 3])
@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 28])
def test_tile_folds(n, k):
    nodes = [h(str(i)) for i in range(n)]
    tile, tree = Tile([x.encode() for x in nodes], k, None), levels(nodes, k)
    assert tile.top.decode() == tree[-1][0]
    for at in range(n):
        value, proof = climb(tree, at, h("new"), k)
        assert tile.fold(at, h("new").encode()) == (value.encode(), "".join(proof).encode())


@pytest.mark.parametrize("params", [MerkleParams(rows_per_piece=3, levels=2), MerkleParams(children=3, levels=1, rows_per_piece=5), MerkleParams()])
def test_against_brute_force(spark, params):
    rng = random.Random(5)
    rows = [(rng.randrange(90), rng.choice([None, "", "en", "é", "zz"]), str(rng.random())) for _ in range(150)]
    rows += [(None, "en", "a"), (None, None, "b"), (4, "en", "same"), (4, "en", "same"), (4, "one", "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumns({c: F.lit("x") for c in ("scope", "rank", "row_no", "value", "proof", "n", "tile", "piece")})
    own = leaf([F.col("doc_id"), F.col("lang"), F.col("text")])
    other = F.when(F.col("doc_id") % 3 == 0, leaf([F.lit("forged")])).otherwise(own)
    made = folded(manifest(docs, own, "lang", "doc_id", {"claimed": other}, params), "claimed", params)
    show = lambda c: F.lower(F.hex(c))
    got = made.select("id", *map(show, ("digest", "subroot", "root")), F.sha2("proof", 256), show("folded_root")).collect()
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    given = [(d, s, h(text(d), text(s), text(t))) for d, s, t in rows]
    forged = h(text("forged"))
    assert sorted(map(tuple, got), key=str) == brute([(d, s, v, forged if d is not None and d % 3 == 0 else v) for d, s, v in given], params.children)


def test_fields_and_empty_table(spark):
    row = spark.range(1).select(field(F.lit(None).cast("string")).alias("a"), field(F.lit("")).alias("b"), field(F.lit("é")).alias("c"), field(F.lit(-12)).alias("d")).head()
    assert tuple(row) == ("-", "0:", "2:é", "3:-12")
    docs = spark.createDataFrame([], "doc_id long, lang string")
    made = manifest(docs, leaf([F.col("doc_id")]), "lang", "doc_id", {"claimed": leaf([F.col("doc_id")])})
    assert folded(made, "claimed").count() == 0
    with pytest.raises(ValueError):
        MerkleParams(children=1)
