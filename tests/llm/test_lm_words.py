"""The language model sees real words in its histories, and its gradient is that of plain loops."""

import numpy as np

from folio.llm import maxent_lm as M


def test_frequent_words_are_contexts_and_classes_of_their_own():
    words = [b"w%dx" % i for i in range(1000)]               # the same ending: hashed ids would be one
    vocab = M.Vocabulary([(w, 5000 - i) for i, w in enumerate(words)])
    h, c, _, _ = M.histories([b" ".join(words)], vocab)
    assert len(set(c[:127].tolist())) == 127
    assert len(set((h // M.CONTEXTS).tolist())) == 1001      # the start, and each word once the previous one


def test_gradient_is_that_of_plain_loops():
    rng = np.random.default_rng(4)
    n_h = 3 * M.BLOCK + 17
    h = np.sort(rng.choice(40 * M.CONTEXTS, n_h, replace=False) // M.CONTEXTS * M.CONTEXTS + rng.integers(0, 60, n_h))
    row = np.repeat(np.arange(n_h), rng.integers(1, 4, n_h))
    cls = (np.arange(len(row)) * 37) % M.CLASSES
    n = rng.integers(1, 9, len(row))
    w, bias = rng.normal(size=(M.FEATURES, M.CLASSES)).astype(np.float32), rng.normal(size=M.CLASSES).astype(np.float32)
    acc = np.zeros((3, M.FEATURES, M.CLASSES), np.float32)
    M.add_gradient(acc, h, row, cls, n, w, bias)
    grad, mass = np.zeros(w.shape), np.zeros(w.shape)
    f = M.features(h)
    for i in range(n_h):
        seen = np.zeros(M.CLASSES)
        seen[cls[row == i]] = n[row == i]
        z = bias + w[f[0, i]].astype(float) + w[f[1, i]] + w[f[2, i]]
        expect = np.exp(z - z.max()) / np.exp(z - z.max()).sum() * seen.sum()
        for k in f[:, i]:
            grad[k] += seen - expect
            mass[k] += np.maximum(seen, expect)
    assert np.allclose(acc[1] - acc[0], grad, atol=1e-3) and np.allclose(acc[0] + acc[2], mass, atol=1e-3)
    got = M.class_terms(h[row], cls, w, bias)
    z = bias + sum(w[x].astype(float) for x in f)
    assert np.allclose(got, M.log_softmax(z)[row, cls] / np.log(10), atol=1e-4)
