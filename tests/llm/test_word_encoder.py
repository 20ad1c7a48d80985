"""The encoder of the word vocabulary, against the library."""

import random

from ragloom.llm import bpe, queries

PARTS = [*" \t\n\r\v\f\x1c\x85", " ", *"aAzZéÉßÿ×÷ªµ.,;:!?)]}#*$%&'<>|\"(_-01²½日İſÅ", "é", "'s", "'LL", "<|endoftext|>", "Word", "word"]


def test_a_word_is_encoded_once_however_it_is_written():
    encoder = bpe.SpacedWords(bpe.load(queries.tokenizer_path(queries.WORD_BPE)))
    texts = ["Étude étude, ÉTUDE!\vétude###", "étude) Étude."]
    whole = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == whole
    assert encoder.count == 1 + len({"", ",", "!", "###", ")", "."})


def test_words_as_the_library(monkeypatch):
    """Odd fragments, texts longer than a slice, and a table that is full after a few words."""
    encoder = bpe.SpacedWords(bpe.load(queries.tokenizer_path(queries.WORD_BPE)), table=40)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 50)
    monkeypatch.setattr(bpe, "WORD_CHARS", 300)
    rnd = random.Random(5)
    texts = ["", " ", "x" * 120] + ["".join(rnd.choices(PARTS, k=rnd.randint(0, 90))) for _ in range(3000)]
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for t, ids, e in zip(texts, encoder.encode(texts), whole, strict=True):
        assert ids.tolist() == e.ids, t
    assert encoder.encode([]) == []
