"""The filter audit against filters run one after another."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("tarnfold.llm")

from tarnfold.llm import audit


def fails(rows):
    """The letters that each row of id, text, part fails."""
    out = []
    for i, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        own["E"] = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        out.append({k for k, v in own.items() if v})
    return out


def plain(rows, good, toxic):
    want = {}
    every = fails(rows)
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, every, strict=True) if (p or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [x for x in left if f in x[1]], [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing = [x for x in mine if f in x[1]]
                want[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(x[1] == {f} for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
        for (p, order, step), row in want.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return want


def test_audit_is_filters_in_turn(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 4)))

    def text():
        t = " ".join(rng.choice([word(), "the", word()]) for _ in range(rng.choice([3, 49, 50, 51, 80])))
        t = t.upper() if rng.random() < 0.2 else t
        return t + rng.choice(["", "", " #1", "\x0b50%"])

    texts = [text() for _ in range(40)] + ["", None, " \n", "word " * 30_000, "A" * 5 + "b" * 95, "A" * 6 + "b" * 94, "Straße|"]
    rows = [(i, rng.choice(texts), rng.choice(["x", "y", None, ""])) for i in range(150)]
    rows += [rows[3], rows[3], (3, "other", "x"), (None, texts[0], "x"), (None, None, None), (200, texts[0], "only")] + [(300 + i, "same", "hot") for i in range(90)]
    df = spark.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, text string, source string, n int, mask string").repartition(4)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in rng.sample(range(400), 150)]
    labels += [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    own = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: list(r)[3:] for r in audit.audit(df, own).collect()}
    assert got == plain(rows, {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None})
    assert audit.audit(df.limit(0), own).count() == 0
    unlabelled = audit.audit(df, own.limit(0))
    assert unlabelled.count() == 600 * 5 and unlabelled.where("good_lost + toxic_lost > 0").count() == 0


def test_matrices():
    m = audit.outcomes()
    assert all(x.shape == (32, 600) for x in m.values())
    # Every mask is removed once in an order, or kept by its last step.
    for a in range(0, 600, 5):
        assert (m["removed"][:, a : a + 5].sum(axis=1) + m["kept"][:, a + 4] == 1).all()
    assert (m["kept"] + m["removed"] + m["redundant"]).max() == 1
    # Shared by the filters that a mask fails: 120 orders for each.
    bits = np.array([bin(x).count("1") for x in range(32)])
    first = [next(i for i, (o, s) in enumerate(audit.STEPS) if o[s - 1] == f) for f in "ABCDE"]
    assert (m["shapley"][:, first].sum(axis=1) == np.where(bits, 120, 0)).all()
