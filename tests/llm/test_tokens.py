"""Token files and packing: exact against encoding whole texts with the library."""

from __future__ import annotations

import random
import struct
import tempfile
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carebook.llm import packing, token_files
from carebook.llm.queries import TOKENIZER
from carebook.llm.tokenizing import PieceEncoder
from tests.llm.data import documents, empty, odd_rows, prose

PLAIN = Tokenizer.from_file(TOKENIZER)
ENCODER = PieceEncoder(TOKENIZER, max_kept=50)


def ids_of(text, end):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'st .,\n\t   　é1日\r!<|endoftext|>\u0085"), max_size=30), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert ENCODER.encode(pa.array(texts, pa.string())).to_pylist() == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_token_text_and_nulls():
    texts = ["a <|endoftext|> b", None, "", "<|endoftext|><|endoftext|>x", " lead", "it's  they'll\n\n x "]
    assert ENCODER.encode(pa.array(texts)).to_pylist() == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_files(spark):
    rows = odd_rows(random.Random(1)) + [(100 - i, prose(random.Random(i), i)) for i in range(40)]
    path = tempfile.mkdtemp(prefix="carebook-tok-") + "/tokens"
    token_files.write_tokens(documents(spark, rows).repartition(5), path, TOKENIZER, page_rows=7, page_bytes=512)
    got = token_files.token_digests(token_files.read_tokens(spark, path)).collect()
    want = sorted((r[0] is not None, r[0] or 0, len(ids_of(r[1], 2)), crc(ids_of(r[1], 2))) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    # Starts follow doc_id order without gaps, null ids first.
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        key = (r.doc_id is not None, r.doc_id or 0)
        assert r.start == at and (last is None or key >= last)
        at, last = at + r.n_tokens, key
    # A doc_id range and single columns.
    part = token_files.read_tokens(spark, path, ["doc_id", "tokens"], first=70, last=72).collect()
    assert {r.doc_id: list(r.tokens) for r in part} == {r[0]: ids_of(r[1], 2) for r in rows if r[0] and 70 <= r[0] <= 72}
    plan = token_files.read_tokens(spark, path, ["doc_id", "n_tokens"], first=70)._jdf.queryExecution().toString()
    scan = plan[plan.index("Physical Plan"):]
    assert "tokens:array" not in scan and "GreaterThanOrEqual(doc_id,70)" in scan


def test_layout(spark):
    path = tempfile.mkdtemp(prefix="carebook-tok-") + "/tokens"
    token_files.write_tokens(documents(spark, [(i, prose(random.Random(i), 50)) for i in range(200)]).coalesce(1), path, TOKENIZER, page_rows=20, page_bytes=1024)
    import glob
    files = [pq.ParquetFile(f) for f in glob.glob(path + "/*.parquet")]
    group = max((f.metadata.row_group(0) for f in files), key=lambda g: g.num_rows)
    by = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in by["tokens.list.element"].encodings)
    assert by["doc_id"].encodings == ("DELTA_BINARY_PACKED",) or "DELTA_BINARY_PACKED" in by["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in by.values())


def test_packing(spark):
    rows = odd_rows(random.Random(2)) + [(200 + i, prose(random.Random(i), 37 * i)) for i in range(30)]
    pieces = packing.pack(documents(spark, rows).repartition(4), TOKENIZER).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    wants = sorted(tuple([r[0] or -1, *ids_of(r[1], 1)]) for r in rows)
    found, open_ = [], {}
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 2048 and len(p.tokens) == p.length and p.offset == 0
        assert p.ids_crc32 == crc(list(p.tokens))
        assert p.sequence_id >> packing.BUCKET_SHIFT == p.length.bit_length() - 1
    # Rebuild each document from its pieces; rows that share an id are told apart by length.
    for p in sorted(pieces, key=lambda p: (p.doc_id or -1, p.doc_tokens, p.start)):
        open_.setdefault((p.doc_id or -1, p.doc_tokens, p.start), []).append(p)
    for (doc, n, start) in [k for k in open_ if k[2] == 0]:
        for copy in range(len(open_[doc, n, 0])):
            ids, at = [], 0
            while at < n:
                piece = open_[doc, n, at][copy]
                ids += piece.tokens
                at += piece.length
            assert at == n
            found.append(tuple([doc, *ids]))
    assert sorted(found) == wants


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 4095, 10_001])
def test_piece_lengths(n):
    import numpy as np
    doc, start, length = packing.pieces_of(np.array([n, 5]), 2048)
    assert length[doc == 0].tolist() == packing.piece_lengths(n, 2048) and sum(length[doc == 0]) == n
    assert start[doc == 0].tolist() == [sum(length[:i]) for i in range((doc == 0).sum())] and length[doc == 1].tolist() == [4, 1]


def test_buckets_and_empty(spark):
    path = tempfile.mkdtemp(prefix="carebook-pack-") + "/packed"
    packing.write_buckets(packing.pack(documents(spark, [(i, prose(random.Random(i), 9)) for i in range(20)]), TOKENIZER), path)
    back = spark.read.parquet(path)
    assert back.where("bucket <> length").count() == 0 and back.count() > 20
    assert packing.pack(empty(spark), TOKENIZER).count() == 0
    path = tempfile.mkdtemp(prefix="carebook-tok-") + "/tokens"
    token_files.write_tokens(empty(spark), path, TOKENIZER)
    assert token_files.token_digests(token_files.read_tokens(spark, path)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty(spark), TOKENIZER, max_length=100)


def test_equal_rows_are_spread(spark):
    """One doc_id and text in half of all rows lies in many files."""
    rows = [(7, "the same text again")] * 600 + [(10 + i, prose(random.Random(i), 5)) for i in range(600)]
    path = tempfile.mkdtemp(prefix="carebook-tok-") + "/tokens"
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        token_files.write_tokens(documents(spark, rows).repartition(4), path, TOKENIZER)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    copies = token_files.read_tokens(spark, path).where("doc_id = 7")
    n = len(ids_of(rows[0][1], 2))
    assert sorted(r.start for r in copies.collect()) == [n * i for i in range(600)]
    shards = [r["count"] for r in spark.read.parquet(path).where("doc_id = 7").groupBy("shard").count().collect()]
    assert len(shards) >= 3 and max(shards) < 300
