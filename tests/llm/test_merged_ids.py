"""What a step and a text of op7 cost: slots that hold ids, and merged ids."""

import numpy as np
import public_tokenizers

from tradewell.llm import attention_lm

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_slots_without_ids_are_not_computed(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [(rng.pareto(1.0, 2000) * 20).astype(np.int64).clip(0, 300).astype(np.uint16) for _ in range(4)]
    vocabulary = attention_lm.Vocabulary(np.append(np.bincount(np.concatenate(texts), minlength=301), len(texts)))
    pairs, n = np.unique(vocabulary.pairs(texts), return_counts=True)
    model = attention_lm.Model(vocabulary, attention_lm.Direct(vocabulary.cell_mass, pairs, n.astype(np.float32)))
    read, told, counted, begins = attention_lm.windows(texts, model.end)
    units, cells = vocabulary.units[read], vocabulary.cells[told]
    powers, made = attention_lm.powers, []
    monkeypatch.setattr(attention_lm, "powers", lambda x, *least: made.append(x.size if x.ndim == 2 else 0) or powers(x, *least))
    model.attention.log_cells(units, cells, begins)
    tail = (cells >= attention_lm.HEAD).sum()
    assert tail > cells.size / 4
    assert sum(made) < cells.size * attention_lm.CLASSES + tail * attention_lm.SLOTS / 2
    told_slots = [wide for _, _, wide, _ in model.attention.direct.groups]
    assert max(told_slots) <= attention_lm.SLOTS and min(told_slots) < attention_lm.SLOTS


def test_merged_pairs_shorten_words_and_spell_them(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "MERGES", 3)
    rows = [(b"qzxqzx", 900), (b"qzx", 500), (b"vkwj", 100), (b"jjqp", 63)]
    words = spark.createDataFrame([(bytearray(w), n) for w, n in rows], "word binary, n bigint")
    plain = attention_lm.Subwords(PATH)
    merges = attention_lm.frequent_pairs(words, PATH)
    counts = {}
    for word, n in rows:
        found = plain.ids([word]).tolist()
        for pair in zip(found, found[1:]):
            counts[pair] = counts.get(pair, 0) + n
    enough = [p for p in counts if counts[p] >= attention_lm.LEAST_MERGED]
    assert list(merges) == sorted(enough, key=lambda p: (-counts[p], p))[:3]
    merged = attention_lm.Subwords(PATH, merges)
    assert plain.size < merged.size <= plain.size + 3
    for word, _ in rows:
        spelled = b"".join(merged.codec.decode_bytes([i]) for i in merged.ids([word]).tolist())
        assert spelled == b" " + word and len(merged.ids([word])) <= len(plain.ids([word]))
    assert len(merged.ids([b"qzxqzx"])) < len(plain.ids([b"qzxqzx"]))
    ids = attention_lm.id_counts(words, PATH, merges)
    assert len(ids) == merged.size + 1 and ids.sum() == sum(n * len(merged.ids([w])) for w, n in rows)


def test_texts_get_the_ids_of_their_words(spark):
    rows = [(bytearray(w), n) for w, n in ((b"alpha", 9), (b"beta", 4), (b"gamma", 2))]
    words = spark.createDataFrame(rows, "word binary, n bigint")
    merges = ((5, 6),)
    frequent = attention_lm.frequent_words(words, PATH, merges, 20.0)
    sent = spark.sparkContext.broadcast((frequent, -1.0, 1))
    texts = ["Beta zzyq alpha", None, "", "\t gamma\x0bgamma unseen ", "qqq", "alpha"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("doc_id", "false held_out", "text", "0 round")
    found = attention_lm.map_batches(docs, attention_lm._encode(sent, PATH, merges), attention_lm.ENCODED, 8).collect()
    logs = {bytes(w): np.log10((n + 0.5) / 20) for w, n in rows}
    subwords = attention_lm.Subwords(PATH, merges)
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for r, text in zip(found, texts):
        w = attention_lm.words_of((text or "").encode())
        assert bytes(r.ids) == subwords.bytes_of(w) and r.n_tokens == len(w) + 1
        assert [bytes(x) for x in r.rare] == [x for x in w if x not in logs] and r.known == len(w) - len(r.rare) + 1
        assert abs(r.base - sum(logs.get(x, 0) for x in w) + 1) < 1e-12
