"""Words that the encoder meets a few at a time, as edits bring them."""

from sigweave.llm.tokens import WordEncoder, vocabulary_path


def test_a_few_new_words_make_no_patterns_ready(monkeypatch):
    encode = WordEncoder(vocabulary_path())
    text = "Grüße von 12 naïve qwertz's, x_y!"
    apart = sum(
        len(e.ids) for e in encode._tokenizer.encode_batch(text.split(), add_special_tokens=False)
    )

    def never(words):
        raise AssertionError("patterns are for many words")

    monkeypatch.setattr(encode, "_in_lines", never)
    assert encode.count(text) == apart
