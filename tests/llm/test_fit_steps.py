"""A step of op7's fit: its gradients against a sum place by place, and what it copies."""

import numpy as np

from tradewell.llm import attention_lm


def _model():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 3000, n).astype(np.uint16) for n in (0, 3, 70, 900, 2600)]
    counts = np.append(np.bincount(np.concatenate(texts), minlength=3000), len(texts))
    vocabulary = attention_lm.Vocabulary(counts)
    pairs, n = np.unique(vocabulary.pairs(texts), return_counts=True)
    model = attention_lm.Model(vocabulary, attention_lm.Direct(vocabulary.cell_mass, pairs, n.astype(np.float32)))
    for name in ("w2", "slots"):
        model.attention.p[name] = (rng.standard_normal(model.attention.p[name].shape) / 8).astype(np.float32)
    read, told, counted, begins = attention_lm.windows(texts, model.end)
    return model, vocabulary.units[read], vocabulary.cells[told], counted, begins


def test_gradients_and_scores_are_those_of_each_place():
    model, units, cells, counted, begins = _model()
    a = model.attention
    units, cells, counted, begins = units[:40], cells[:40], counted[:40], begins[:40]
    z, _ = a.hidden(units, begins)
    want = {n: np.zeros(a.p[n].shape) for n in ("w2", "slots")}
    logs = np.zeros(units.size)
    for k, (unit, cell, counts) in enumerate(zip(units.ravel(), cells.ravel(), counted.ravel())):
        kind = int(attention_lm.class_of(np.array([cell]))[0])
        levels = [("w2", a.p["w2"], a.direct.classes[unit], kind, ())]
        if kind >= attention_lm.HEAD:
            c = kind - attention_lm.HEAD
            levels.append(("slots", a.p["slots"][c], a.direct.slots[unit * attention_lm.TAIL + c], (cell - attention_lm.HEAD) % attention_lm.SLOTS, c))
        for name, weights, direct, mine, at in levels:
            share = attention_lm.powers((z[k:k + 1] @ a.scaled(weights)))[0].astype(float) * direct
            share /= share.sum()
            logs[k] += np.log(share[mine])
            share[mine] -= 1
            want[name][at] += np.outer(z[k], share) * (counts / counted.sum())
    found = a.gradients(units, cells, counted, begins)
    assert set(found) == set(a.p) and all(found[n].shape == a.p[n].shape for n in a.p)
    for name in want:
        assert np.abs(want[name]).max() > 1e-4 and np.allclose(found[name], want[name], atol=1e-6)
    assert np.allclose(a.log_cells(units, cells, begins).ravel(), logs, atol=1e-4)


def test_batches_are_not_copied_and_weights_move_as_one(monkeypatch):
    model, units, cells, counted, begins = _model()
    gradients, shared = model.attention.gradients, []

    def seen(u, c, n, b):
        shared.append(np.shares_memory(u, units) and np.shares_memory(c, cells))
        return gradients(u, c, n, b)

    monkeypatch.setattr(model.attention, "gradients", seen)
    before, starts = model.attention.flat().copy(), begins.copy()
    assert attention_lm.Fit(model.attention, 0.02).learn(units, cells, counted, begins) == counted.sum()
    assert shared and all(shared)
    assert len({id(w.base) for w in model.attention.p.values()}) == 1
    assert (model.attention.flat() != before).any() and (begins == starts).all()
