import random
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardstream.llm.merkle import append_log, build_manifest, height, leaf_digest, place, siblings
from tests.llm.data import no_documents, odd_documents


def sha(text):
    return sha256(text.encode()).hexdigest()


def levels_of(leaves, arity):
    """All levels of a tree, built level by level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[k : k + arity])) for k in range(0, len(below), arity)])
    return levels


def path_of(levels, index, arity):
    steps = []
    for level in levels[:-1]:
        first = index // arity * arity
        run = level[first : first + arity]
        steps.append(("".join(run[: index - first]), "".join(run[index - first + 1 :])))
        index //= arity
    return steps


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def by_hand(rows, arity):
    """{(source, id, leaf): (subroot, root, path)} of (source, id, text) rows."""
    trees = {}
    for source, i, text in rows:
        trees.setdefault(source, []).append((i is not None, i, sha(written(source) + written(i) + written(text))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels_of([leaf for *_, leaf in sorted(trees[s], key=lambda x: (x[0], x[1] or 0, x[2]))], arity) for s in names}
    top = levels_of([built[s][-1][0] for s in names], arity)
    out = []
    for at, s in enumerate(names):
        for k, (_, i, leaf) in enumerate(sorted(trees[s], key=lambda x: (x[0], x[1] or 0, x[2]))):
            path = path_of(built[s], k, arity) + path_of(top, at, arity)
            out.append((i, leaf, built[s][-1][0], top[-1][0], tuple(path)))
    return sorted(out, key=repr)


def manifest(docs, arity, levels, claimed=None):
    return build_manifest(docs, "source", "doc_id", leaf_digest(["source", "doc_id", "text"]), claimed, arity, levels)


def proofs(made):
    root = made.root()
    return sorted(
        ((r.id, r.leaf, r.subroot, root, tuple((s.before, s.after) for s in r.path)) for r in made.proofs().collect()), key=repr
    )


def sources(spark, seed, sizes):
    rng = random.Random(seed)
    ids = iter(rng.sample(range(-500, 5000), sum(sizes.values())))
    rows = [(s, next(ids), f"text {rng.random()}") for s, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "source string, doc_id bigint, text string")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(2, 5))
def test_places_are_those_of_the_log(n, arity):
    levels, leaves = height(n, arity), [str(k) for k in range(n)]
    log, built = append_log(leaves, levels, arity), levels_of(leaves, arity)
    assert len(log) == sum(map(len, built))
    for level, nodes in enumerate(built):
        for index, node in enumerate(nodes):
            assert log[place(level, index, n, levels, arity)] == node
            before, after = siblings(level, index, n, levels, arity)
            if level < levels:
                assert ("".join(log[k] for k in before), "".join(log[k] for k in after)) == path_of(built, index * arity**level, arity)[level] or level


@pytest.mark.parametrize(("arity", "levels"), [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_equal_to_building_level_by_level(spark, arity, levels):
    sizes = {"a": 200, "b": 1, "Z": 9, "ä": 8, "": 3, None: 17, "c": 2, "🂡": 1}
    rows, docs = sources(spark, 1, sizes)
    made = manifest(docs, arity, levels)
    assert proofs(made) == by_hand(rows, arity)
    check = made.check().collect()
    root = made.root()
    for r in check:
        want = next(x for x in by_hand(rows, arity) if x[:2] == (r.id, r.leaf))
        assert r.proof_sha256 == sha("".join(b + a for b, a in want[4])) and r.folded_root == root
    log = {}
    for r in made.log().collect():
        log.setdefault(r.tree, {})[r.place] = r.digest
    for source, n in sizes.items():
        leaves = [leaf for _, leaf, *_ in sorted((x for x in by_hand(rows, arity) if any(x[0] == i and s == source for s, i, _ in rows)))]
        whole = append_log(leaves, height(n, arity), arity)
        assert log[written(source)] == dict(enumerate(whole))


def test_a_changed_row_leads_to_another_root(spark):
    rows, docs = sources(spark, 2, {"a": 40, "b": 5})
    claimed = F.when(F.col("doc_id") % 3 == 0, F.sha2(F.lit("other"), 256))
    made = manifest(docs, 4, 2, claimed)
    root = made.root()
    wrong = {r.id for r in made.check().collect() if r.folded_root != root}
    assert wrong == {i for _, i, _ in rows if i % 3 == 0} and wrong


def test_a_single_row_is_the_root(spark):
    _, docs = sources(spark, 3, {"a": 1})
    made = manifest(docs, 16, 2)
    (row,) = made.check().collect()
    assert row.leaf == row.subroot == row.folded_root == made.root()
    assert row.proof_sha256 == sha("")


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "'t' as tree", "1 as rank", "2 as size", "3 as nodes", "'d' as digest")
    rows = [(r.source, r.doc_id, r.text) for r in docs.collect()]
    assert proofs(manifest(docs, 2, 2)) == by_hand(rows, 2)
    empty = manifest(no_documents(spark), 16, 2)
    assert empty.root() is None and empty.check().count() == empty.proofs().count() == empty.log().count() == 0
