import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orgmill.llm import packing, token_counts, token_files
from orgmill.llm.common import shared_path
from orgmill.llm.word_encoder import WordEncoder

PIECE, WORD, BYTE = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", None, "a", "  ", "Hello, World. It's  3.14 <|endoftext|> É é\n\nx", "A.b,C. Don'T \x1c\x85  ok", "ΑΣ. Σας, <|ENDOFTEXT|>", "日本語 text. and,more", "x" * 3000, "the of.\n" * 900, "the of.\n" * 900]


def rows(spark, values):
    return spark.createDataFrame([(i, t, 7) for i, t in enumerate(values)], "doc_id long, text string, n_tokens int")


def test_word_encoder_equals_the_library():
    encoder, library = WordEncoder(WORD, memory_words=5), Tokenizer.from_file(WORD)
    for _ in range(2):
        ids, offsets = encoder.ids(pa.array(ODD, pa.string()))
        for i, text in enumerate(ODD):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids
    many = pa.array([f"é{i} Word Ö." * i for i in range(99)])
    ids, offsets = encoder.ids(many.slice(37, 40))
    assert [len(library.encode(x.as_py(), add_special_tokens=False).ids) for x in many.slice(37, 40)] == (offsets[1:] - offsets[:-1]).tolist()


def test_a_file_of_another_kind_is_encoded_whole():
    encoder, library = WordEncoder(BYTE), Tokenizer.from_file(BYTE)
    assert WordEncoder(WORD).cuts and not encoder.cuts
    ids, offsets = encoder.ids(pa.array(ODD, pa.string()))
    for i, text in enumerate(ODD):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_null_ids_repeated_rows_and_very_long_texts(spark):
    values = [(None, "a b"), (None, "a b"), (3, "c d e"), (3, "c d e"), (4, "word " * 300_000), (None, None)]
    df = spark.createDataFrame(values, "doc_id long, text string")
    counts = token_counts.count_tokens(df, PIECE).toPandas()
    assert len(counts) == 6 and counts.doc_id.isna().sum() == 3 and counts[counts.doc_id == 3].n_tokens.nunique() == 1 and counts[counts.doc_id == 4].n_tokens.item() >= 300_000
    packed = packing.pack(df, WORD).toPandas()
    assert packed.length.sum() == 2 * 3 + 2 * 4 + 300_001 + 1 and packed.groupby("sequence_id").length.sum().max() <= 4096 and packed.doc_id.isna().sum() == 3
    at = shared_path(spark, "odd-files")
    token_files.write_ids(df, at, WORD)
    back = token_files.read_ids(spark, at, with_ids=False).toPandas().sort_values("start")
    assert back.doc_id.isna().tolist() == [True] * 3 + [False] * 3 and back.n_tokens.sum() == 2 * 3 + 2 * 4 + 300_001 + 1


@pytest.mark.parametrize("path", [PIECE, BYTE, WORD])
@pytest.mark.parametrize("overlap", [1, 8, 64])
def test_spliced_counts_equal_whole_counts(path, overlap):
    by = token_counts.Counter(path)
    rng = np.random.default_rng(1)
    parts = ["the", " a", "  ", "é", "日本", "\n", " xyzzy", ".", "tion", "\t", " 12", " " * 9]
    for n in (1, 50, 400):
        text = "".join(rng.choice(parts, n))
        assert token_counts.spliced(text, by, 40, overlap)[0] == by.counts([text])[0]
    assert token_counts.spliced("x" * 900, by, 40, overlap)[0] == by.counts(["x" * 900])[0]


def test_count_tokens(spark):
    found = {r["doc_id"]: r for r in token_counts.count_tokens(rows(spark, ODD), PIECE, limit=100, chunk=64, overlap=8).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for i, text in enumerate(ODD):
        n = len(library.encode(text or ""))
        assert (found[i]["n_tokens"], found[i]["n_bytes"], found[i]["over_limit"]) == (n, len((text or "").encode()), n > 100)
    assert found[9]["n_chunks"] > 10
    assert token_counts.count_tokens(rows(spark, []), PIECE).count() == 0


def test_pack(spark):
    library = Tokenizer.from_file(WORD)
    found = packing.pack(rows(spark, ODD), WORD, capacity=64).toPandas()
    for i, text in enumerate(ODD):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = found[found.doc_id == i].sort_values("piece")
        assert own.start.tolist() == list(range(0, len(ids), 64)) and own.length.sum() == len(ids)
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[a : a + 64].tobytes()) for a in range(0, len(ids), 64)]
    for _, bin_ in found.sort_values("offset").groupby("sequence_id"):
        assert bin_.offset.tolist() == [0, *bin_.length.cumsum().tolist()[:-1]] and bin_.length.sum() <= 64
    assert found.sequence_id.nunique() == -(-found.length.sum() // 64)
    assert packing.pack(rows(spark, []), WORD).count() == 0


def test_plan_uses_every_piece_once_and_few_sequences():
    rng = np.random.default_rng(0)
    for n in (0, 1, 30, 2000):
        counts = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 257, n), return_counts=True))}
        used, bins = {}, 0
        for items, times in packing.plan(counts, 256):
            assert sum(a * k for a, k in items) <= 256
            bins += times
            for a, k in items:
                used[a] = used.get(a, 0) + k * times
        total = sum(a * k for a, k in counts.items())
        assert used == counts and -(-total // 256) <= bins <= total / 256 * 1.02 + 4


def test_token_file_round_trip(spark):
    at, library = shared_path(spark, "ids"), Tokenizer.from_file(WORD)
    many = ODD + [f"document {i} about the same words and numbers {i * 7}" for i in range(300)]
    token_files.write_ids(rows(spark, many), at, WORD)
    found, start = token_files.read_ids(spark, at).orderBy("doc_id").collect(), 0
    for r, (i, text) in zip(found, enumerate(many), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (i, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert [r["doc_id"] for r in token_files.read_ids(spark, at, [4, 200, 9999]).orderBy("doc_id").collect()] == [4, 200]
    empty = shared_path(spark, "ids")
    token_files.write_ids(rows(spark, []), empty, WORD)
    assert token_files.read_ids(spark, empty).count() == 0


def test_words_that_are_kept_and_forgotten_give_the_same_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = WordEncoder(path)
    parts = [pa.array([" ".join(f"word{i * k} Ünï{i} x.{i}" for i in range(60)) for _ in range(3)], pa.string()) for k in range(1, 5)]
    want = [WordEncoder(path).ids(p)[0].tolist() for p in parts]
    for words in (5, 1, 50, 10**6):
        for p, ids in zip(parts, want):
            assert encoder.ids(p)[0].tolist() == ids
            encoder.keep(words)
            assert len(encoder.hashes) <= max(words, 5) or words == 10**6
            assert encoder.ids(p)[0].tolist() == ids
