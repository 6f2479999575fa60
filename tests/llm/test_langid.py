"""The byte network: its gradients, its accuracy on held-out texts, and edge rows."""

import random

import numpy as np
import pytest

from airtally.llm import langid

WORDS = {
    "en": "the of and that with this from have which their would there been when".split(),
    "de": "der die und nicht mit auf eine sich werden über für können müssen schön".split(),
    "fr": "le la les des être avec pour dans qui ça où même très déjà français".split(),
}


def texts(many, seed=1):
    pick = random.Random(seed)
    return [(lang, " ".join(pick.choices(WORDS[lang], k=pick.randrange(5, 150)))) for lang in sorted(WORDS) for _ in range(many)]


@pytest.fixture(scope="module")
def net():
    sample = texts(150)
    return langid.train(np.concatenate([langid.cut(t.encode()[:256]) for _, t in sample]), [lang for lang, _ in sample])


def test_windows_hold_every_byte():
    for n in (0, 1, 255, 256, 257, 512, 1000):
        data = bytes(k % 250 + 1 for k in range(n))
        rows = langid.cut(data)
        assert rows.shape[1] == 256 and len(rows) == max(1, -(-n // 256))
        if n > 256:
            assert rows[-1].tobytes() == data[-256:]
            assert b"".join(r.tobytes() for r in rows[: n // 256]) == data[: n // 256 * 256]


def test_gradients(net):
    random_ = np.random.default_rng(0)
    windows, target = random_.integers(1, 200, (5, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    parts = [net.vectors, *net.filters, *net.offsets, net.weight, net.bias]
    wide = [p.astype(np.float64) for p in parts]
    k = len(langid.WIDTHS)
    copy = langid.ByteCNN(net.languages, wide[0], wide[1 : 1 + k], wide[1 + k : 1 + 2 * k], wide[-2], wide[-1])

    def loss():
        _, most, _ = copy.responses(windows)
        return -langid.log_softmax(np.concatenate(most, axis=1) @ copy.weight + copy.bias)[np.arange(5), target].mean()

    for part, gradient in zip(wide, langid.gradients(copy, windows, target), strict=True):
        for at in random_.choice(part.size, min(6, part.size), replace=False):
            old = part.flat[at]
            part.flat[at] = old + 1e-6
            up = loss()
            part.flat[at] = old - 1e-6
            assert (up - loss()) / 2e-6 == pytest.approx(gradient.flat[at], abs=1e-5)
            part.flat[at] = old


def test_held_out_accuracy(net):
    sample = texts(60, seed=9)
    found = net.predict([t for _, t in sample])
    assert np.mean([f[0] == lang for f, (lang, _) in zip(found, sample, strict=True)]) > 0.97
    assert all(0 <= f[1] <= 1 for f in found)


def test_edge_rows(documents, edges, net):
    rows = {r["doc_id"]: r for r in langid.identify(documents([*edges, "123 !!", (None, "the of and")], ("score", "lang_pred")), net).collect()}
    assert len(rows) == len(edges) + 2
    for key, text in enumerate([*edges, "123 !!"]):
        letters = any(c.isalpha() for c in text or "")
        assert (rows[key]["lang_pred"] == "und") == (not letters)
        assert rows[key]["lang_pred"] in {"und", *WORDS}


def test_fit_and_stage(spark, documents):
    sample = texts(40, seed=3)
    labelled = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(sample)] + [(900, None, "en"), (901, "x", None)], "doc_id long, text string, lang string")
    net = langid.fit(labelled, rows=1000)
    assert net.languages == sorted(WORDS)
    docs = documents(["the of and that with this from", None, "", "12 34"], ("score",))
    kept = langid.keep_known(docs, net, least=0.4)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [0]


def test_nothing_to_learn_from(documents):
    net = langid.fit(documents([]))
    assert [r["lang_pred"] for r in langid.identify(documents(["the of"]), net).collect()] == ["und"]
    assert langid.identify(documents([]), net).collect() == []


def test_forward_pass_against_plain_loops():
    """What the network serves with, window by window and filter by filter."""
    chance = np.random.default_rng(3)
    texts = ["ein kurzer Satz", "another one, longer than the first", "x", "¿qué?"] * 3
    net = langid.train(np.concatenate([langid.cut(t.encode()[: langid.WINDOW]) for t in texts]), ["a", "b", "c", "d"] * 3)
    text = "".join(chance.choice(list("abcdé ß?")) for _ in range(700))
    windows = langid.cut(text.encode())
    logits = net.logits(windows)
    for window, row in zip(windows, logits, strict=True):
        span = net.vectors[window]
        pooled = []
        for width, f, offset in zip(langid.WIDTHS, net.filters, net.offsets, strict=True):
            for k in range(f.shape[1]):
                best = max(float(span[at : at + width].ravel() @ f[:, k] + offset[k]) for at in range(len(span) - width + 1))
                pooled.append(max(best, 0.0))
        raw = np.array(pooled) @ net.weight + net.bias
        assert np.allclose(raw - raw.max() - np.log(np.exp(raw - raw.max()).sum()), row, atol=1e-3)
    mean = np.mean(logits.astype(float), axis=0)
    lang, score = net.predict([text])[0]
    share = np.exp(mean - mean.max())
    assert lang == net.languages[int(mean.argmax())] and score == pytest.approx(float((share / share.sum()).max()), abs=1e-3)
