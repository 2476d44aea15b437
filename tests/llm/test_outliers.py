from __future__ import annotations

import re

import numpy as np

from panelprep.llm import outliers as o

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_base_statistics_of_odd_documents(odd_docs):
    rows, df = odd_docs
    got = [(str(r["doc_id"]), *tuple(r)[1:7]) for r in o.judge(df).collect()]
    assert sorted(got) == sorted((str(i), *base(t)) for i, t, *_ in rows)


def test_repeated_words():
    rng = np.random.default_rng(2)
    for kinds, n in ((2, 30), (5, 100), (1 << 21, 50)):
        numbers = rng.integers(0, min(kinds, 5), n)
        text = " ".join(map(str, numbers))
        assert o.repeated_words(numbers, kinds) == base(text)[4]


def test_outliers_go_and_clean_texts_stay(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(3000)]
    clean = [" ".join(rng.choice(words, rng.integers(80, 300))) for _ in range(300)]
    rows = [(i, t, "en", f"s{i % 2}") for i, t in enumerate(clean)]
    rows += [(1000 + i, " ".join(w + "!!" for w in t.upper().split()), "en", "s0") for i, t in enumerate(clean[:15])]
    rows += [(2000 + i, " ".join(w + "#*$" for w in t.split()), None, None) for i, t in enumerate(clean[:15])]
    got = {r["doc_id"]: r for r in o.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i]["kept"] for i in range(300))
    assert not any(got[1000 + i]["kept"] for i in range(15))
    # too few for an estimate of their own or together: no verdict but that of the base rules
    assert all(got[2000 + i]["distance"] is None and got[2000 + i]["kept"] for i in range(15))


def test_steps_equal_plain_concentration():
    rng = np.random.default_rng(3)
    assert abs(o._consistency(0.75, 8) - 1.295) < 0.01
    z = rng.normal(size=(200_000, 8))
    d = (z**2).sum(axis=1)
    inner = z[d <= np.quantile(d, 0.75)]
    assert abs(np.cov(inner.T).diagonal().mean() * o._consistency(0.75, 8) - 1) < 0.02


def plain_estimate(z):
    """Concentration of three starts over whole bins of distances, by numpy; the smallest determinant."""
    value = np.round(z / o._GRID) * o._GRID
    quartile = [np.sort(value, axis=0)[np.searchsorted(np.arange(1, len(z) + 1), len(z) * q)] for q in (0.25, 0.5, 0.75)]
    floors = np.diag(o._FLOORS**2)
    found = []
    for mean, spread in ((quartile[1], (quartile[2] - quartile[0]) / 1.349), (value.mean(axis=0), value.std(axis=0)), (quartile[1], np.ones(8))):
        cov = np.diag(spread**2) + floors
        for _ in range(60):
            d = np.einsum("ni,ij,nj->n", z - mean, np.linalg.inv(cov), z - mean)
            bins = np.clip(np.floor(np.log2(np.maximum(d, 1e-6)) * 24 + 480), 0, o.BINS - 1)
            last = np.sort(bins)[int(np.ceil(0.75 * len(z))) - 1]
            inner = z[bins <= last]
            mean, cov = inner.mean(axis=0), np.cov(inner.T, bias=True) * o._consistency(0.75, 8) + floors
            found.append((np.linalg.slogdet(cov)[1], mean, cov))
    return min(found, key=lambda f: f[0])


def test_fit_equals_plain_concentration(spark):
    rng = np.random.default_rng(8)
    clean = rng.normal(size=(900, 8)) @ rng.normal(size=(8, 8)) * 0.5
    groups = {"a": np.vstack([clean, rng.normal(6, 0.3, size=(250, 8))]), "b": rng.standard_t(3, size=(400, 8))}
    vectors = spark.createDataFrame([(g, z.tolist()) for g, zs in groups.items() for z in zs], "group string, z array<double>").repartition(5)
    got = {r["group"]: r for r in o.fit(vectors).collect()}
    for g, z in groups.items():
        _, mean, cov = plain_estimate(z)
        root = np.zeros((8, 8))
        for (i, j), v in zip(o._LOWER, got[g]["root"]):
            root[i, j] = v
        lower = np.linalg.inv(root)
        assert np.allclose(got[g]["mean"], mean, atol=0.05) and np.allclose(lower @ lower.T, cov, atol=0.2)


def test_cutoff_is_the_quantile():
    assert abs(o.chi_square(0.05, 8) - 15.507) < 1e-3 and abs(o.chi_square(0.001, 8) - 26.124) < 1e-3


def test_one_statistic_alone_can_reject(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(3000)]
    clean = [" ".join(rng.choice(words, rng.integers(80, 300))) for _ in range(300)]
    odd = {"symbols": lambda t: " ".join(w + "#" * (k % 5 < 2) for k, w in enumerate(t.split())), "marks": lambda t: t.replace(" ", "! "),
           "upper": str.upper, "lines": lambda t: "\n".join([t] + [t[:20]] * 9), "digits": lambda t: t.translate(str.maketrans("abcdefgh", "12345678"))}
    rows = [(i, t, "en", "s") for i, t in enumerate(clean)] + [(1000 + i, change(clean[i]), "en", "s") for i, change in enumerate(odd.values())]
    got = {r["doc_id"]: r for r in o.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i]["kept"] for i in range(300))
    assert {name: got[1000 + i]["kept"] for i, name in enumerate(odd)} == dict.fromkeys(odd, False)


def test_null_sources_are_no_pool(spark):
    rng = np.random.default_rng(5)
    words = [f"{'abcdefgh'[i % 8]}{i}" for i in range(2000)]
    sources = [None] * 60 + ["s1"] * 30 + ["s2"] * 30
    rows = [(i, " ".join(rng.choice(words, 80)), lang, s) for lang in ("en", None) for i, s in enumerate(sources)]
    statistics = o.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    group = {r["cell"]: r["group"] for r in o._groups(statistics).collect()}
    assert len(group) == 6 and len(set(group.values())) == 4
    for lang in ('"0":"en",', ""):
        assert group[f'{{{lang}"1":"s1"}}'] == group[f'{{{lang}"1":"s2"}}'] != group[f"{{{lang.rstrip(',')}}}"]


def test_empty_table(no_docs):
    assert o.judge(no_docs).count() == 0
