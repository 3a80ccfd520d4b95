"""What a worker of the token files holds at once does not grow with the texts of its task."""

import public_tokenizers
import pyarrow as pa

from orgmill.llm import token_files, word_encoder
from orgmill.llm.common import shared_path

WORD = public_tokenizers.path("word_bpe_49k.json")


class Watched:
    def __init__(self, tokenizer):
        self.tokenizer, self.most = tokenizer, 0

    def encode_batch_fast(self, words, **options):
        self.most = max(self.most, len(words))
        return self.tokenizer.encode_batch_fast(words, **options)


def test_the_library_encodes_a_bounded_number_of_words_at_once():
    texts = pa.array([" ".join(f"w{i}x{i * 7}" for i in range(k, k + 10_000)) for k in range(0, 30_000, 10_000)])
    encoder = word_encoder.WordEncoder(WORD)
    encoder.tokenizer = watched = Watched(encoder.tokenizer)
    ids, offsets = encoder.ids(texts)
    assert 0 < watched.most <= 10_000 and len(encoder.hashes) == 30_000
    for i in range(3):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == watched.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids


def test_frames_are_read_without_a_shuffle(spark, capsys):
    at = shared_path(spark, "ids")
    token_files.write_ids(spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string"), at, WORD)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables of any size
    try:
        found = token_files.read_ids(spark, at, with_ids=False)
        found.explain()
        plan = capsys.readouterr().out
        assert found.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
