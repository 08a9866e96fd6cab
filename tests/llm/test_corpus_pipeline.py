"""The pipeline stage by stage against what each stage should do to its own input."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from clipsense.llm import mixing, secret_scan, simhash
from tests.llm.test_corpus_operators import CLASHES, WORD, base_secrets, groups_by_hand, print_by_hand, targets_by_hand

SF_DIR = "/root/testdata/sf0.001"


def key(row):
    return (row["doc_id"] is None, row["doc_id"], row["text"] or "")


def test_stages_on_the_smallest_table(spark):
    docs = corpus_pipeline.documents(spark, SF_DIR)
    secret = docs.limit(1).selectExpr("99999L AS doc_id", "'Here the secret = \"abcdefgh\" of the house.' AS text", "lang", "source", "n_chars")
    docs = docs.union(secret)
    for c in CLASHES:
        docs = docs.selectExpr("*", f"7 AS `{c}`")
    columns = docs.columns
    (_, language), (_, near), (_, secrets), (_, mix), (_, pack) = corpus_pipeline.STAGES

    before = sorted(docs.collect(), key=key)
    told = language(spark, docs, SF_DIR)
    after = sorted(told.collect(), key=key)
    assert told.columns == columns
    assert after == [r for r in before if r["text"] and any(map(str.isalpha, r["text"]))]

    single = near(spark, told, SF_DIR)
    roots = groups_by_hand([print_by_hand(r["text"]) for r in after])
    groups = defaultdict(list)
    for row, root in zip(after, roots):
        groups[root].append(row)
    left = sorted(single.collect(), key=key)
    assert single.columns == columns and left == sorted((min(g, key=key) for g in groups.values()), key=key)
    assert len(left) < len(after)

    masked = secrets(spark, single, SF_DIR)
    clean = sorted(masked.collect(), key=key)
    assert masked.columns == columns and len(clean) == len(left)
    found = 0
    for old, new in zip(sorted(left, key=lambda r: r["doc_id"]), sorted(clean, key=lambda r: r["doc_id"])):
        assert new["text"] == secret_scan.redact(old["text"]) and new["n_chars"] == len(new["text"])
        assert not base_secrets(new["text"])
        found += old["text"] != new["text"]
    assert found

    mixed = mix(spark, masked, SF_DIR)
    taken = sorted(mixed.collect(), key=key)
    targets, _ = targets_by_hand([(r["doc_id"], r["text"], None, r["source"]) for r in clean])
    own = {r["doc_id"]: r["text"] for r in clean}
    sizes = Counter()
    for r in taken:
        words = WORD.findall(r["text"])
        assert words and len(words) <= 3 * len(WORD.findall(own[r["doc_id"]]))
        sizes[r["source"]] += len(words)
    assert mixed.columns == columns
    assert all(abs(sizes[s] - t) <= mixing.BLOCK + 0.05 * t for s, t in targets.items())

    packed = pack(spark, mixed, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in taken}
    filled = Counter()
    for r in packed:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and len(filled) <= 1.05 * sum(filled.values()) / 2048 + 1


def test_documents_stay_without_labels(spark):
    docs = corpus_pipeline.documents(spark, SF_DIR)
    held = "crc32(cast(doc_id as string)) % 5 = 0"
    for lang in ("CAST(NULL AS string)", f"CASE WHEN {held} THEN lang END"):
        bare = docs.drop("lang").join(docs.selectExpr("doc_id", f"{lang} AS lang").distinct(), "doc_id").select(docs.columns)
        told = corpus_pipeline.identify_language(spark, bare, SF_DIR)
        expected = sorted((r for r in bare.collect() if r["text"] and any(map(str.isalpha, r["text"]))), key=key)
        assert expected and sorted(told.collect(), key=key) == expected


def test_run_is_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
    assert all(0 <= r["ids_crc32"] < 2**32 for r in rows) and zlib.crc32(b"") == 0


def test_empty_table_passes_through(spark):
    docs = corpus_pipeline.documents(spark, SF_DIR).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
    assert simhash.MOST_BITS == 3
