import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dispatchlake.llm import token_counts

TEXTS = ["Hello, world! it's 2024", "<|endoftext|>x<|startoftext|>", "É café café naïve", "don't  stop\n\n\tnow", "ΑΣ ΣΑΣ", "日本語 テキスト", "a" * 3000, " nbsp em \u0085x", "word " * 3000, "<|endoftext", "İstanbul ſ K"]


def check(spark, most):
    path = token_counts.tokenizer_path()
    rows = [(0, None), (1, ""), (2, " \n"), (None, "no id"), *((10 + i, t) for i, t in enumerate(TEXTS)), (10, TEXTS[0]), (10, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x")).repartition(3)
    library = Tokenizer.from_file(path)
    want = sorted(((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows), key=str)
    assert sorted(map(tuple, token_counts.count_tokens(docs, path, most).collect()), key=str) == want


def test_equals_the_library(spark):
    check(spark, token_counts.BROADCAST_WORDS)


def test_words_beyond_the_broadcast_are_joined(spark):
    check(spark, 3)
    check(spark, 0)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert token_counts.count_tokens(docs, token_counts.tokenizer_path()).collect() == []


def test_a_tokenizer_that_joins_white_space_with_words_is_refused(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    token_counts.PreTokens(token_counts.tokenizer_path()).verify()
    other = Tokenizer(models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
    other.pre_tokenizer = pre_tokenizers.Metaspace()
    other.save(str(tmp_path / "other.json"))
    with pytest.raises(ValueError):
        token_counts.PreTokens(str(tmp_path / "other.json")).verify()


def test_a_task_sends_its_words_when_they_are_many_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_counts, "FLUSH_BYTES", 1000)
    texts = [f"{'w' * 300}{i} again" for i in range(40)]
    sent = list(token_counts._distinct(1)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    held = [b for batch in sent for b in batch.column("words").to_pylist()]
    assert len(sent) > 5 and all(len(b) < 2000 for b in held) and sum(b.count(b"w" * 300) for b in held) == 40
