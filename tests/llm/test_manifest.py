from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from roomledger.llm import manifest
from tests.llm.cases import empty, messy


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict, text: str | None) -> str:
    values = [text if c == "text" else row[c] for c in manifest.FIELDS]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """The root, and per leaf its place and siblings level by level."""
    paths, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for k, own in enumerate(at):
            run = level[own // 16 * 16:own // 16 * 16 + 16]
            paths[k].append((own % 16, run[:own % 16] + run[own % 16 + 1:]))
        level = [h(*level[k:k + 16]) for k in range(0, len(level), 16)]
        at = [own // 16 for own in at]
    return level[0], paths


def brute(rows: list[dict]) -> list[tuple]:
    sources: dict[str | None, list[dict]] = {}
    for row in rows:
        sources.setdefault(row["source"], []).append({**row, "leaf": leaf(row, row["text"])})
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for own in sources.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
    built = {s: tree([r["leaf"] for r in sources[s]]) for s in names}
    root, above = tree([built[s][0] for s in names])
    found = []
    for s, path_above in zip(names, above):
        for row, path in zip(sources[s], built[s][1]):
            node = row["leaf"]
            if row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                lowered = "".join(c.lower() if c.isascii() else c for c in row["text"])
                node = leaf(row, lowered)
            for place, others in path + path_above:
                node = h(*others[:place], node, *others[place:])
            proof = h(*(d for _, others in path + path_above for d in others))
            found.append((row["doc_id"], row["leaf"], built[s][0], root, proof, node, node == root))
    return sorted(found, key=repr)


def rows_of(docs) -> list[dict]:
    return [r.asDict() for r in docs.select(*manifest.FIELDS).collect()]


def audited(docs) -> list[tuple]:
    return sorted((tuple(r) for r in manifest.audit(docs).collect()), key=repr)


def test_positions_are_those_of_the_log():
    for n in [1, 2, 15, 16, 17, 31, 32, 33, 255, 256]:
        for levels in {manifest.levels_above(n), 2}:
            builder = manifest.Builder(levels)
            leaves = [hashlib.sha256(bytes([k, 1])).digest() for k in range(n)]
            for digest in leaves:
                builder.add(digest)
            log = builder.finish()
            level, nodes = leaves, 0
            for k in range(levels + 1):
                nodes += len(level)
                for at, digest in enumerate(level):
                    place = 32 * manifest.position(k, at, n)
                    assert log[place:place + 32] == digest
                level = [manifest.combined(level[j:j + 16]) for j in range(0, len(level), 16)]
            assert len(log) == 32 * nodes
            for at in (0, n // 2, n - 1):
                assert manifest.fold(leaves[at], manifest.own_path(log, at, n, levels)) == log[-32:]


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert audited(docs) == brute(rows_of(docs))


def test_several_rounds_equal_brute_force(spark):
    """More than 256 leaves in a source and more than 256 sources; the hot source has a third of all rows."""
    rows = [(k, f"Text {k % 50}", "en", "hot" if k % 3 == 0 else f"s{k % 601}", k) for k in range(2700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert audited(docs) == brute(rows_of(docs))
    built = manifest.build_manifest(docs)
    assert len(built.rounds) == 2 and len(built.above) == 2
    assert max(len(r.log) for blocks in built.rounds + built.above for r in blocks.collect()) <= 32 * (256 + 16 + 1)


def test_messy_rows(spark):
    assert audited(messy(spark)) == brute(rows_of(messy(spark)))
    assert audited(empty(spark)) == []
    found = manifest.proofs(manifest.build_manifest(messy(spark))).collect()
    assert all(manifest.fold(r.digest, r.path) == r.root for r in found)


@pytest.mark.parametrize("column,value", [("text", "changed"), ("lang", None), ("n_chars", 3)])
def test_any_change_shows(spark, column, value):
    docs = spark.createDataFrame([(k, "a Text", "en", "s", 6) for k in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    kind = docs.schema[column].dataType
    changed = docs.withColumn(column, F.when(F.col("doc_id") == 7, F.lit(value).cast(kind)).otherwise(F.col(column)))
    before, after = ({r.doc_id: r for r in manifest.proofs(manifest.build_manifest(d)).collect()} for d in (docs, changed))
    assert before[7].root != after[7].root
    assert manifest.fold(after[7].digest, before[7].path) != before[7].root
    assert manifest.fold(before[7].digest, before[7].path) == before[7].root
