import random

import numpy as np
import public_tokenizers

from tradewell.llm import records

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_plain_words_need_no_pattern_and_get_the_library_s_ids(monkeypatch):
    encoder, asked = records.Encoder(VOCABULARY), []
    library = encoder.tokenizer

    class Watched:
        def encode(self, text, **options):
            asked.append(text)
            return library.encode(text, **options)

    encoder.tokenizer = Watched()
    rng = random.Random(3)
    words = ["".join(rng.choices("abzéñöøÿß÷×ÀÉ09.,'$%<|>`~!_-^TσΣİ́", k=rng.randint(1, 7))) for _ in range(5000)]
    words += ["'s", "it's", "a's.", "end.'", "<|endoftext|>", "x<|endoftext|>", "école,", "école", "!!!", "..."]
    for word in words:
        want = library.encode(word, add_special_tokens=False).ids + [2]
        assert np.frombuffer(encoder.encode(word.encode(), 2), encoder.kind).tolist() == want, word
    asked.clear()
    encoder.clear()
    encoder.older.clear()
    encoder.encode("Straße, ¡no! erlyin$$$ école. fürchten hello-- ...".encode(), 2)
    assert asked == ["¡no!"]


def test_records_do_not_depend_on_the_slices(spark, monkeypatch):
    rows = [(k if k % 5 else None, f"word{k} été, {k}" * (k % 4) or None) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    whole = sorted(map(tuple, records.round_trip(docs, VOCABULARY).collect()), key=repr)
    monkeypatch.setattr(records, "SLICE_BYTES", 40)
    assert sorted(map(tuple, records.round_trip(docs, VOCABULARY).collect()), key=repr) == whole


def test_words_kept_are_bounded_and_those_in_use_stay(monkeypatch):
    monkeypatch.setattr(records, "WORDS_KEPT", 20)
    encoder, asked = records.Encoder(VOCABULARY), []
    ask = encoder.ask
    encoder.ask = lambda word: asked.append(word) or ask(word)
    for k in range(300):
        encoder.encode(b"often %s" % f"{k:03d}".translate({48 + i: 97 + i for i in range(10)}).encode(), 2)
        assert len(encoder) + len(encoder.older) <= 2 * 20 + 4
    assert asked.count(b"often") == 1
