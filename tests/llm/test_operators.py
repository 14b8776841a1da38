"""The training-data operators against brute force on small made-up rows, hard cases included."""

import hashlib
import json
import random
import re
import zlib

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewell.llm import (attention_lm, chat, decontaminate, graph, jaccard, language, mixing, quality, records,
                           suffix_dedup, token_count)
from tradewell.llm.common import held_out

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
HARD = [None, "", " \n\t ", "x", "Ünï çødé ßtraße", "a, b. C.", "<|endoftext|> B<|ENDOFTEXT|>c", "don't I'LL 12.5 é,", "ab" * 5000,
        "same same same\nsame same same\n" * 40]


def made(n, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeEé") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    shared = [" ".join(rng.choice(words) for _ in range(k)) for k in (12, 40, 90)]
    rows = []
    for d in range(n):
        text = " ".join([" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))), rng.choice(shared),
                         " ".join(rng.choice(words) for _ in range(rng.randint(0, 20)))])
        if rows and rng.random() < 0.3:
            old = rng.choice(rows)[1].split()
            old[rng.randrange(len(old))] = rng.choice(words)
            text = " ".join(old)
        rows.append((d, text))
    rng.shuffle(rows)
    return rows


ROWS = made(120) + [(1000 + i, t) for i, t in enumerate(HARD)] + [(1003, "x"), (1008, "ab" * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "size clash", i) for i, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, size int").repartition(3)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_quality(docs):
    found = {(r.doc_id): r for r in quality.measure(docs).collect()}
    assert len(quality.measure(docs).collect()) == len(ROWS)
    for d, t in ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 2000 else None
        r = found[d]
        assert (r.n_words, r.word_chars, r.n_dup_lines) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)))
        assert hit is None or r.n_repeat_words == len(hit)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert not found[1000].kept and not found[1008].kept and not found[1009].kept
    assert quality.keep(docs).columns == docs.columns
    assert quality.keep(docs).count() == sum(r.kept for r in quality.measure(docs).collect())


@pytest.mark.parametrize("base", [0x915, 0xE01, 0x430])  # Devanagari, Thai, Cyrillic
def test_quality_is_alike_in_scripts_of_more_bytes(base):
    rng = random.Random(9)
    words = ["".join(rng.choice("aaeeiioutnsrhld") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    clean = [" ".join(rng.choice(words) for _ in range(n)) for n in (50, 55, 60, 150, 400, 1500, 4000)]  # each length class
    other = [t.translate({97 + i: base + i for i in range(26)}) for t in clean]
    assert [r[-1] for r in quality.judge([t.encode() for t in clean], quality.DEFAULT)] == [True] * len(clean)
    assert [r[-1] for r in quality.judge([t.encode() for t in other], quality.DEFAULT)] == [True] * len(clean)
    for text in (clean[3], other[3]):  # three thousand bytes that say the same again stay out
        assert not quality.judge([(text + "\n").encode() * 9], quality.DEFAULT)[0][-1]


def test_suffix_dedup(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "MEETING_BYTES", 10_000)
    texts = [(d, (t or "").encode()) for d, t in ROWS]
    first = {}
    for d, t in texts:
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], d), d)
    want = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    assert rows_of(suffix_dedup.digest(docs)) == sorted(want, key=repr)


def digest_by_brute_force(texts):
    first = {}
    for d, t in texts:
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], d), d)
    out = []
    for d, t in texts:
        gone = {k for i in range(len(t) - 49) if first[t[i:i + 50]] < d for k in range(i, i + 50)}
        rest = bytes(c for k, c in enumerate(t) if k not in gone)
        out.append((d, len(t), len(gone), sum(k - 1 not in gone for k in gone), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, kept", [(1, 1 << 18), (1, 300), (1 << 12, 1 << 18)])
def test_suffix_dedup_splits_hot_anchors(spark, docs, monkeypatch, hot, kept):
    for name, value in (("BUCKET_BYTES", 20_000), ("MEETING_BYTES", 10_000), ("HOT_BYTES", hot), ("WINDOWS_KEPT", kept)):
        monkeypatch.setattr(suffix_dedup, name, value)
    assert rows_of(suffix_dedup.digest(docs)) == digest_by_brute_force([(d, (t or "").encode()) for d, t in ROWS])


def test_suffix_dedup_bounds_the_bytes_that_meet(spark, monkeypatch):
    """A phrase shorter than a window in every document, with other text around: no bucket grows with their number."""
    for name, value in (("BUCKET_BYTES", 20_000), ("MEETING_BYTES", 10_000), ("HOT_BYTES", 4_000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    inner = suffix_dedup._met_stretches

    def watched(*given):
        work = inner(*given)

        def run(table):
            size = sum(len(suffix_dedup.zstandard.decompress(r["text"])) for r in table.to_pylist() if r["text"])
            assert size < 60_000  # 97,134 where the stretches of the phrase meet whole
            return work(table)
        return run

    monkeypatch.setattr(suffix_dedup, "_met_stretches", watched)
    rng = random.Random(5)
    rows = [(d, "%030x the same licence of every file here %030x" % (rng.getrandbits(120), rng.getrandbits(120))) for d in range(3000)]
    found = suffix_dedup.digest(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    assert len(found) == 3000 and all(r.n_removed == 0 for r in found)


def test_jaccard(docs, monkeypatch):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = [(d, shingles(t)) for d, t in ROWS]
    top = {d: d for d, _ in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, u in sets[:i]:
            if s and u and 100 * len(s & u) >= 85 * len(s | u):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    want = sorted(((d, len(s), root(d)) for d, s in sets), key=repr)
    assert rows_of(jaccard.components(docs, 4, (85, 100))) == want
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 300)  # cut blocks
    monkeypatch.setattr(jaccard, "COMMON", 5)  # common shingles
    assert rows_of(jaccard.components(docs, 4, (85, 100))) == want
    kept = jaccard.keep_first(docs, 4, (85, 100))
    assert kept.columns == docs.columns and kept.count() == len({r for _, _, r in want})


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 50), (50, 100), (7, 7)], "a bigint, b bigint")
    assert {r.node: r.root for r in graph.components(edges).collect()} == {**{k: 0 for k in range(41)}, 100: 50, 50: 50}


def test_decontamination(spark, docs, monkeypatch):
    pick = dict(ROWS)
    items = [(1, " ".join(pick[3].split()[2:30])), (2, "nothing like it at all"), (3, pick[5].split()[0]), (4, None), (5, ""),
             (10, " ".join(pick[3].split()[2:30]).upper())]
    bench = spark.createDataFrame(items, "item_id bigint, text string")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    want = []
    for d, t in ROWS:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(10, len(v))
            parts = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in parts:
                    hit.update(range(i, i + n))
                    ids.add(str(item))
        want.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    want.sort(key=repr)
    assert rows_of(decontaminate.digest(docs, bench)) == want
    assert rows_of(decontaminate.digest(docs, bench, block_bytes=40)) == want  # several blocks
    assert decontaminate.drop(docs, bench).count() == sum(not r[-1] for r in want)
    assert rows_of(decontaminate.digest(docs, bench.limit(0)).select("contaminated").distinct()) == [(False,)]


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontamination_searches_items_without_id(spark, block):
    """Their words are hit and their documents dropped; together they count as one item without a name, as in the SQL."""
    passage = [" ".join(f"{c}{k}" for k in range(12)) for c in "abc"]
    bench = spark.createDataFrame([(None, passage[0]), (7, passage[1]), (None, passage[2]), (8, passage[2])], "item_id bigint, text string")
    texts = [f"x {passage[0]} y", f"x {passage[1]} y {passage[0]}", f"{passage[2]}", "x y z"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted(tuple(r) for r in decontaminate.digest(table, bench, block_bytes=block).collect())
    want = [(0, 14, 12, 1, []), (1, 26, 24, 2, ["7"]), (2, 12, 12, 2, ["8"]), (3, 3, 0, 0, [])]
    assert found == [(d, n, hit, items, hashlib.sha256(",".join(i).encode()).hexdigest(), hit > 0) for d, n, hit, items, i in want]
    assert [r.doc_id for r in decontaminate.drop(table, bench, block_bytes=block).collect()] == [3]


def test_records_and_counts(spark, docs):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in sorted(ROWS, key=lambda r: (r[0], r[1] or ""))]
    start, want = 0, []
    for d, x in ids:
        x = x + [2]
        want.append((d, start, len(x), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x))))
        start += len(x)
    assert rows_of(records.round_trip(docs, VOCABULARY)) == sorted(want, key=repr)
    counts = sorted(((d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in ROWS), key=repr)
    assert rows_of(token_count.count_tokens(docs, VOCABULARY).drop("over_limit")) == counts
    assert records.round_trip(docs.limit(0), VOCABULARY).count() == 0


def test_damaged_record():
    data = records.frame(b"abcdef")
    assert records.unframe(data, 0) == b"abcdef"
    with pytest.raises(ValueError):
        records.unframe(data[:14] + b"X" + data[15:], 0)


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (i % 37)), None if i % 5 == 0 else f"s{i % 5 % 3}", "x") for i in range(600)] + [(7, None, "s1", "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies string")
    found = mixing.digest(docs, rows_a_block=50).collect()
    assert len(found) == len(rows) and all(r.taken <= 3 * r["size"] for r in found)
    for source in {(r.source_size, r.target) for r in found}:
        mine = [r for r in found if (r.source_size, r.target) == source]
        assert abs(sum(r.taken for r in mine) - source[1]) < 0.1 * source[1] + 80
    assert rows_of(mixing.digest(docs, rows_a_block=50)) == sorted(map(tuple, found), key=repr)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_language(spark):
    rows = [(i, "the cat sat on the mat and the dog ran " * 3 if i % 2 else "der hund und die katze sitzen auf der matte " * 3,
             "en" if i % 2 else "de") for i in range(40)] + [(90, None, "en"), (91, "123 ...", None), (92, "und der hund", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    held = held_out("doc_id", 4, 2)
    found = {r.doc_id: r for r in language.predict(docs, language.learn(docs.where(~held)), held).collect()}
    assert all(found[d].lang_pred == lang for d, _, lang in rows[:40])
    assert found[90].lang_pred == found[91].lang_pred == "und" and found[92].lang_pred == "de"
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.values())
    assert {r.lang_pred for r in language.predict(docs, language.learn(docs.limit(0)), held).collect()} == {"und"}


def test_language_model(spark, docs, monkeypatch):
    import math
    from collections import Counter

    monkeypatch.setattr(attention_lm, "FREQUENT_WORDS", 50)  # the others are joined
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    held = held_out("doc_id", 5, 1)
    tokens = [(d, [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())), None]) for d, t in ROWS]
    counts = Counter(w for d, ws in tokens if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((d, len(ws), sum(counts[w] > 0 for w in ws),
                   round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), 6)) for d, ws in tokens)
    found = attention_lm.score(docs, held, path).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == want
    assert all(r.train_tokens == total and r.score < 0 for r in found)
    assert attention_lm.score(docs.limit(0), held, path).count() == 0


def test_language_model_learns_a_grammar(spark):
    """Held-out texts of a generated grammar are more probable to the model than to the word counts."""
    import random

    rng = random.Random(5)
    follows = {w: [f"{rng.choice('bdfglmnprst')}{rng.choice('aeiou')}{rng.choice('bdfglmnprst')}{k}" for k in range(2)] for w in range(200)}
    names = sorted({x for v in follows.values() for x in v})
    after = {n: rng.sample(names, 2) for n in names}

    def text():
        said = [rng.choice(names)]
        for _ in range(rng.randrange(20, 80)):
            said.append(rng.choice(after[said[-1]]))
        return " ".join(said)

    docs = spark.createDataFrame([(k, text()) for k in range(1500)], "doc_id bigint, text string").repartition(2)
    found = attention_lm.score(docs, held_out("doc_id", 5, 1), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    held = found.where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert held.score > held.base


def _small_model():
    import numpy as np

    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 400, n).astype(np.uint16) for n in (0, 3, 40, 900, 5000)]
    counts = np.append(np.bincount(np.concatenate(texts), minlength=500), len(texts))
    vocabulary = attention_lm.Vocabulary(counts)
    pairs, n = np.unique(vocabulary.pairs(texts), return_counts=True)
    model = attention_lm.Model(vocabulary, attention_lm.Direct(vocabulary.cell_mass, pairs, n.astype(np.float32)))
    return np, rng, texts, model


def test_attention_gives_a_distribution_and_reads_no_later_id():
    np, rng, texts, model = _small_model()
    fit = attention_lm.Fit(model.attention, 0.02)
    for _ in range(8):
        model.learn(fit, texts)
    start = rng.integers(0, 500, 37).astype(np.uint16)
    told = [start, *(np.append(start, np.uint16(k)) for k in range(500))]
    scores = model.score(told)
    read, cells, counted, begins = attention_lm.windows(told, model.end)
    found = model.attention.log_cells(model.vocabulary.units[read], model.vocabulary.cells[cells], begins) / np.log(10)
    found = found + model.vocabulary.inside[cells]
    each = [found[a:b][counted[a:b]] for a, b in zip(np.flatnonzero(begins), [*np.flatnonzero(begins)[1:], len(begins)])]
    assert all(np.allclose(e[:37], each[0][:37], atol=1e-4) for e in each)  # what follows changes nothing
    assert abs(sum(10 ** e[37] for e in each) - 1) < 1e-3  # the end, or one of 500 ids
    assert np.allclose(scores, [e.sum() for e in each], atol=1e-2)
    assert np.allclose(scores, [model.score([t], 1)[0] for t in told], atol=1e-2)  # one chunk at a time


def test_attention_gradients_lower_the_loss():
    np, _, texts, model = _small_model()
    before = model.score(texts).sum()
    fit = attention_lm.Fit(model.attention, 0.01)
    assert sum(model.learn(fit, texts) for _ in range(24)) > 0
    assert model.score(texts).sum() > before


def test_language_model_fits_a_share_of_every_part(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "FIT_IDS", 1000)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = ["x " * 301_000, None] + [f"text {k} of {k * k}" for k in range(700)]
    subwords = attention_lm.Subwords(path)
    rows = [(k % attention_lm.ROUNDS, bytearray(subwords.bytes_of(attention_lm.words_of((t or "").encode())))) for k, t in enumerate(texts)]
    training = spark.createDataFrame(rows, "round int, ids binary").repartition(3)
    ids = attention_lm.id_counts(attention_lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")), path)
    ids[-1] = len(texts)
    vocabulary = attention_lm.Vocabulary(ids)
    direct = attention_lm.direct_path(training, vocabulary)
    assert (direct.classes.sum(axis=1).round(3) == 1).all()
    model = attention_lm.Model(vocabulary, direct)
    before = model.attention.flat().copy()
    seen = attention_lm.fit(model, training)
    assert 0.8 < seen * attention_lm.SHARE / ids.sum() < 1.3
    assert (model.attention.flat() != before).any()


def test_windows_score_each_id_once():
    import numpy as np

    texts = [np.arange(n, dtype=np.uint16) for n in (0, 1, 15, 16, 17, 100)]
    read, told, counted, begins = attention_lm.windows(texts, 999)
    assert told[counted].tolist() == [x for t in texts for x in (*t.tolist(), 999)] and begins.sum() == len(texts)


def test_chat(spark):
    control = "</s>[INST] ok [/INST]"
    hard = [control, "<|end|>", "<\\|end|>", "a<", "|b", "[\\\\INST]", "", None, "<<SYS>>x<</SYS>>"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hard)] + [(2, 0, None, "x"), (None, 5, "assistant", "y")]
    rows += [(3, 0, "user", "twice")] * 2
    said = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("score", F.lit("clash"))
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(said)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r or "", t or "") for _, _, r, t in rows[:len(hard)]]
    assert back[1].trained == "".join(t or "" for k, t in enumerate(hard) if k % 2)
    assert back[None].trained == "y" and len(back[3].turns) == 2 and len(back) == 4


def test_best_branch(spark):
    tree = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 2.0), ("t", 4, 3, 9.0), ("t", 5, 4, 0.0), ("t", 8, 9, 1.0), ("t", 9, 8, 1.0)]
    rows = [(t, i, p, s, "user", f"m{i}") for t, i, p, s in tree]
    messages = spark.createDataFrame(rows, "tree string, id bigint, parent bigint, score double, role string, text string")
    paths = chat.best_paths(messages, per_tree=2).collect()
    by_leaf = {leaf: [r.id for r in sorted((p for p in paths if p.leaf == leaf), key=lambda p: -p.place)] for leaf in {p.leaf for p in paths}}
    assert by_leaf == {2: [1, 2], 5: [1, 3, 4, 5]}


def test_pipeline_stages():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixture", "binary_records"]
    assert json.dumps(corpus_pipeline.ORACLE_SQL) == "null"
