"""Tokenization, packing and token files against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import build
from tokenizers import Tokenizer

from lodeworks.llm import packing, token_files, token_ids

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    rng = random.Random(5)
    bits = list("abzABZ019 .,'\"-_!?\n\t  ") + [
        "'s", "'ll", "é", "ß", "é", " ", "中", "\x01", "<|endoftext|>", "  ", "ing",
        "the", "%%", "…", "🙂", "²", "K", "İ", "\x85", " ", "Σ",
    ]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(3000)] + [None, ""]
    for name_ in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext"):
        texts += [name_, f"a {name_} b", f"{name_}b ", f" a\n{name_}", f"{name_}{name_}'s", f"é {name_}\u3000"]
    ids, counts = token_ids.encoder(public_tokenizers.path(name)).encode(pa.array(texts))
    encode, at = plain(name), 0
    for text, n in zip(texts, counts):
        assert ids[at : at + n].tolist() == encode(text), text
        at += n


@pytest.mark.parametrize("name", FILES)
def test_control_names_can_be_plain_text(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>'s  <|endoftext|>\n"]
    ids, counts = token_ids.encoder(public_tokenizers.path(name), plain_text=True).encode(pa.array(texts))
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(wanted, []) and counts.tolist() == list(map(len, wanted))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.one_of(st.integers(0, 3), st.integers(0, 1 << 17), st.integers(0, 2**64 - 1)), max_size=900
    )
)
def test_words_decode_to_the_ids(values):
    ids = np.array(values, np.uint64)
    words, chunks = token_files.encode(ids)
    assert (token_files.decode(words, chunks, len(ids)) == ids).all()


def test_small_ids_share_a_word():
    words, _ = token_files.encode(np.ones(240, np.uint64))
    assert len(words) == 4


def test_files_hold_all_documents_in_order(spark, tmp_path, odd_docs, odd_rows):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(odd_docs, path, public_tokenizers.path(FILES[0]))
    rows = token_files.read_token_files(spark, path, with_ids=True).collect()
    encode = plain(FILES[0])
    wanted = sorted(
        ((i, t or "") for i, t, _ in odd_rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])
    )
    rows = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [i for i, _ in wanted]
    at = 0
    for row, (_, text) in zip(rows, wanted):
        ids = np.array([*encode(text), 1], "<u4")
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert bytes(row["ids"]) == ids.tobytes() and row["ids_crc32"] == zlib.crc32(ids.tobytes())
        at += len(ids)


def test_rows_without_ids_are_dealt_out(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows = [(None, f"{'abcdefgh'[i % 8]}{i} words", None) for i in range(400)] + [(5, "five", None)]
    docs = build(spark, rows).repartition(4)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        token_files.write_token_files(docs, path, public_tokenizers.path(FILES[0]))
    finally:
        spark.conf.set(setting, before)
    assert spark.read.parquet(path).select("shard").distinct().count() > 3
    got = sorted(token_files.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    encode = plain(FILES[0])
    wanted = [np.array([*encode(t), 1], "<u4").tobytes() for t in sorted(t for i, t, _ in rows if i is None)]
    assert [bytes(r["ids"]) for r in got[:400]] == wanted and got[400]["doc_id"] == 5
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]


def test_empty_table_gives_empty_files(spark, tmp_path, no_docs):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(no_docs, path, public_tokenizers.path(FILES[0]))
    assert token_files.read_token_files(spark, path).count() == 0


def check_sequences(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_places_every_id_once(odd_docs, odd_rows):
    rows = packing.pack_documents(
        odd_docs, public_tokenizers.path(FILES[1]), 64, with_ids=True
    ).collect()
    check_sequences(rows, 64)
    encode = plain(FILES[1])
    wanted = sorted([*encode(t), 1] for _, t, _ in odd_rows)
    # Pieces of one document follow each other by start; equal documents are alike.
    texts = {}
    for row in rows:
        texts.setdefault((row["doc_id"], row["doc_tokens"]), []).append(row)
    found = []
    for (_, size), pieces in texts.items():
        pieces.sort(key=lambda r: (r["start"], bytes(r["ids"])))
        copies = sum(r["start"] == 0 for r in pieces)
        for k in range(copies):
            mine = pieces[k::copies]
            ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in mine), "<u4").tolist()
            assert len(ids) == size
            assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in mine)
            found.append(ids)
    assert sorted(found) == wanted


def test_histogram_places_all_within_capacity():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.randint(1, 50)
        histogram = {
            n: rng.randint(1, 10**9) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))
        }
        slots = packing.place(histogram, capacity)
        assert len(slots) <= 2 * sum(capacity // n + 1 for n in histogram)
        for n, count in histogram.items():
            mine = sorted(s.rank for s in slots if s.length == n)
            assert mine[0] == 0 and all(r < count for r in mine)


def test_packing_wastes_little(spark):
    rows = spark.range(20_000).selectExpr(
        "id AS doc_id", "0L AS start", "CAST(1 + pmod(xxhash64(id), 400) AS LONG) AS length", "'x' AS offset"
    )
    packed = packing.pack(rows, 512).collect()
    assert len(packed) == 20_000
    used = check_sequences(packed, 512)
    assert sum(r["length"] for r in packed) / (512 * used) > 0.98


def test_packing_of_nothing(no_docs):
    assert packing.pack_documents(no_docs, public_tokenizers.path(FILES[1])).count() == 0


def test_longer_pieces_than_a_sequence_are_an_error(spark):
    rows = spark.createDataFrame([(1, 0, 9)], "doc_id long, start long, length long")
    with pytest.raises(ValueError, match="longer"):
        packing.pack(rows, 8)
