import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import docs_of, odd_rows
from tidemark.llm.token_counts import _counter, count_tokens, library_of, tokenizer_digest
from tidemark.session import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a <|endoftext|> b<|endoftext|>", "<|endoftext|> x", "x <|endoftext|>", " lead", "trail ", "two  blanks", "tab\t x", "nl \n y",
    "a\u00a0 b", "a \u2003b", "é è\u0301 x", "don't  stop 've", "1 2 34 five6", "a \x1c b", "日本 語 テ", "🙂 🙂", " ", "\n", "a \u200b b", "a\u3000 b",
]


@pytest.fixture(scope="module")
def count():
    return _counter("tokenizers", open(PATH, "rb").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def whole(library, text):
    return len(library.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("text", ODD)
def test_pieces_count_as_the_library_does(count, library, text):
    assert count(text) == whole(library, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", "\n", "the", "'s", "<|endoftext|>", "12"])), max_size=12).map(" ".join))
def test_any_text_counts_as_the_library_does(count, library, text):
    text = text.encode("utf-8", "replace").decode()
    if text:
        assert count(text) == whole(library, text)


def test_odd_rows_and_cache(spark, library):
    cache = new_folder(spark, "cache")
    rows = [*odd_rows(), (99, "word " * 600, "a")]
    docs = docs_of(spark, rows)
    expected = sorted(
        ((i, len((t or "").encode()), whole(library, t or ""), whole(library, t or "") > 512) for i, t, _ in rows), key=repr
    )
    for _ in range(2):
        got = count_tokens(docs, PATH, cache)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
        # each different text is stored once, and the second run stores nothing
        assert spark.read.parquet(cache).count() == len({t or "" for _, t, _ in rows})
    count_tokens(docs_of(spark, [(1, "new text", "a"), (2, "one two", "a")]), PATH, cache).count()
    assert spark.read.parquet(cache).count() == len({t or "" for _, t, _ in rows}) + 1


def test_other_tokenizers_have_counts_of_their_own(spark):
    import sentencepiece

    path, cache = public_tokenizers.path("piece_bpe_32k.model"), new_folder(spark, "cache")
    docs = docs_of(spark, [(1, "one two three", "a"), (2, None, "a")])
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, path, cache).collect()} == {1: len(model.encode("one two three")), 2: 0}
    word = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(word)
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, word, cache).collect()} == {1: whole(library, "one two three"), 2: 0}
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2
    assert tokenizer_digest(path) != tokenizer_digest(word)
    with pytest.raises(ValueError):
        library_of("x.txt")


def test_empty_table(spark):
    assert count_tokens(docs_of(spark, []), PATH, new_folder(spark, "cache")).count() == 0
