"""The weights of op7 are fitted on every training id."""

import numpy as np

from tradewell.llm import attention_lm


def test_every_chunk_is_fitted(monkeypatch):
    vocabulary = attention_lm.Vocabulary(np.arange(1, 400, dtype=np.float64))
    direct = attention_lm.Direct(vocabulary.cell_mass, np.zeros(0, np.int32), np.zeros(0, np.float32))
    model = attention_lm.Model(vocabulary, direct)
    fitted = []
    gradients = model.attention.gradients
    monkeypatch.setattr(model.attention, "gradients", lambda u, c, counted, b: fitted.append(int(counted.sum())) or gradients(u, c, counted, b))
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 398, n).astype(np.uint16) for n in (0, 5, 3000, 17, 9000)]
    seen = model.learn(attention_lm.Fit(model.attention, 0.01), texts)
    assert seen == sum(fitted) == sum(len(t) + 1 for t in texts)
