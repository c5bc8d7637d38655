import public_tokenizers
import pyarrow as pa
import pytest

from aeroband.llm.token_files import MARKS, WordEncoder

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def plain_ids(texts):
    from tokenizers import Tokenizer

    return [found.ids for found in Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)]


def test_every_letter_before_every_mark_is_that_of_the_tokenizer():
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    encode = WordEncoder(PATH)
    for start in range(0, len(letters), 10_000):
        texts = [" ".join(f"a{c}{mark}" for mark in MARKS) for c in letters[start:start + 10_000]]
        assert [ids.tolist() for ids in encode(pa.array(texts))] == plain_ids(texts)


@pytest.mark.parametrize("text", [
    "Aक़. ज़! फ़, ড়? ঢ়; য়: ਖ਼. ਸ਼!",  # letters that the normal form takes apart
    "é. é. 가. 각! K. Å? ﬁ. İ. Σ.",  # letters that it joins, or that change otherwise
    "word... a.b, (x) #tag $5 100% x&y *", "", " \n ", "one\ntwo  three",
])
def test_words_with_odd_letters(text):
    assert [ids.tolist() for ids in WordEncoder(PATH)(pa.array([text]))] == plain_ids([text])


def test_only_parts_of_words_are_kept():
    text = "Word word. WORD, word;; Été été! 12. (x) <|endoftext|>"
    encode = WordEncoder(PATH)
    assert [ids.tolist() for ids in encode(pa.array([text, None, text]))] == plain_ids([text, "", text])
    assert sorted(encode._known) == sorted(["", "word", ".", ",", ";;", "été", "!", "12.", "(x)", "<|endoftext|>"])


@pytest.mark.parametrize("direct", [True, False])
def test_forgotten_words_are_learnt_again(monkeypatch, direct):
    monkeypatch.setattr("aeroband.llm.token_files.CACHED_WORDS", 6)
    texts = ["one two, three", "Four. five six seven eight nine", "one vier fünf! SECHS", "", "one two, three"]
    encode = WordEncoder(PATH)
    assert encode._direct
    encode._direct = direct
    found = [ids.tolist() for text in texts for ids in encode(pa.array([text]))]
    assert found == plain_ids(texts)
    assert len(encode._known) <= 9
