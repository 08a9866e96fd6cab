"""The Merkle manifest against a plain tree in Python."""

import hashlib
import random
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clipsense.llm import merkle, queries

from .test_corpus_operators import COLUMNS, SF_DIR, odd_rows

CAPITALS = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(row):
    values = [None if row[c] is None else str(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree_by_hand(leaves):
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([sha("".join(rows[-1][i : i + 8])) for i in range(0, len(rows[-1]), 8)])
    return rows


def path_by_hand(rows, at):
    path = []
    for nodes in rows[:-1]:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        path.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        at //= 8
    return path


def manifest_by_hand(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_by_hand(r))
    trees = {g: tree_by_hand([leaf_by_hand(r) for r in sorted(groups[g], key=order)]) for g in names}
    top = tree_by_hand([trees[g][-1][0] for g in names])
    found = []
    for k, g in enumerate(names):
        for i, row in enumerate(sorted(groups[g], key=order)):
            path = path_by_hand(trees[g], i) + path_by_hand(top, k)
            now = {**row.asDict(), "text": row["text"].translate(CAPITALS)} if tampered(row) else row
            folded = leaf_by_hand(now)
            for before, after in path:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in path))
            found.append((str(row["doc_id"]), leaf_by_hand(row), trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(found)


def third(row):
    return row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0


def lowered():
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lower).otherwise(F.col("text"))}


def told(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r["doc_id"]), *[r[c] for c in names[1:]]) for r in df.select(*names).collect())


@pytest.mark.parametrize("block_levels", [1, 2, 4])
def test_manifest_is_the_plain_tree(spark, block_levels):
    """With one level a block, 200 documents take up to three rounds, the last subtrees not full."""
    odd = spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)
    for df in (odd, queries.documents(spark, SF_DIR)):
        got = told(merkle.manifest(df, present=lowered(), block_levels=block_levels))
        assert got == manifest_by_hand(df.collect(), third)
        assert len({v for *_, v in got}) == 2


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 73, 513])
def test_ragged_trees(spark, n):
    """Every size of the last run, in blocks of eight leaves."""
    rows = [(i, f"text {i}", "en" if i else None, "s", 6) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert told(merkle.manifest(df, block_levels=1)) == manifest_by_hand(df.collect(), lambda row: False)


def test_many_groups_make_a_tree_of_their_own(spark):
    draw = random.Random(4)
    rows = [(i, f"t{i}", draw.choice([None, "", "é", "z", *map(str, range(150))]), None, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert told(merkle.manifest(df, block_levels=1)) == manifest_by_hand(df.collect(), lambda row: False)


def test_paths_lead_to_the_root(spark):
    df = merkle.manifest(queries.documents(spark, SF_DIR), proofs=True, block_levels=2)
    for row in df.collect():
        path = [(p["before"], p["after"]) for p in row["path"]]
        assert merkle.fold(row["leaf"], path) == row["root"] and row["verified"]
        assert sha("".join(b + a for b, a in path)) == row["proof_sha256"]
        assert all(len(b + a) <= 7 * 64 for b, a in path)


def test_every_change_is_seen(spark):
    """A change of any column, also to and from null, breaks just the rows that have it."""
    df = queries.documents(spark, SF_DIR)
    odd_id = F.col("doc_id") % 2 == 1
    for column, other in [("source", F.lit(None).cast("string")), ("n_chars", F.col("n_chars") + 1), ("lang", F.concat("lang", F.lit(" ")))]:
        got = merkle.manifest(df, present={column: F.when(odd_id, other).otherwise(F.col(column))}).collect()
        assert all(r["verified"] == (r["doc_id"] % 2 == 0) for r in got)


def test_hot_and_repeated_rows_are_leaves_each(spark):
    rows = [(7, "same", "en", "s", 4)] * 300 + [(i, "x", "en", "s", 1) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = merkle.manifest(df, block_levels=1)
    assert told(got) == manifest_by_hand(df.collect(), lambda row: False)


def test_odd_rows_have_one_result_each(spark):
    odd = spark.createDataFrame(odd_rows(), COLUMNS)
    assert Counter(r["doc_id"] for r in merkle.manifest(odd).collect()) == Counter(r[0] for r in odd_rows())
    assert merkle.manifest(spark.createDataFrame([], COLUMNS)).count() == 0


def test_a_block_meets_at_most_eight_subtrees_a_round(spark):
    """Rows sent in a round stay below twice the blocks, whatever the last subtree lacks."""
    for blocks in (9, 65, 129, 449):
        rows = [("t", k, blocks, sha(str(k))) for k in range(blocks)]
        roots = merkle.staged(spark.createDataFrame(rows, "tree string, block bigint, blocks bigint, root string"))
        top = tree_by_hand([r[3] for r in rows])
        for r in merkle.exchange(roots).collect():
            assert r["root"] == top[-1][0]
            assert [(p["before"], p["after"]) for p in r["path"]] == path_by_hand(top, r["block"])
