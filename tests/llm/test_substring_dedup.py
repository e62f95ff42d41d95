import random
import re
from collections import Counter

from tavola.llm.substring_dedup import substring_dedup
from tests.llm.conftest import EDGE


def brute(rows, width=50):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        if i is not None:
            for j in range(len(w) - width + 1):
                k = tuple(w[j:j + width])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if i is not None and first[tuple(w[j:j + width])] < i:
                gone[j:j + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


def test_against_brute_force(spark, make):
    rnd = random.Random(3)
    def noise(n):
        return [rnd.choice("alpha beta gamma delta epsilon zeta eta theta été ß".split()) for _ in range(n)]
    a = noise(140)
    j = " ".join
    rows = EDGE + [(20, j(a)), (21, j(a)), (21, j(a)), (22, "\n".join(a[:70] + noise(20))), (23, "\t ".join(noise(8) + a[60:130])),
                   (24, j(a[:49])), (25, j(["w"] * 130)), (26, j(["w"] * 60)), (5, j(noise(30) + a[40:100] + noise(30))),
                   (27, j(a[40:100] + noise(3) + a[:55])), (28, j(noise(400))), (29, "word " * 120), (30, "word\x0b" * 60)]
    for i in range(40):  # near copies with one edit each
        b = list(a)
        b[rnd.randrange(len(b))] = "edit"
        rows.append((100 + i, j(b)))
    got = substring_dedup(make(rows)).collect()
    assert Counter(map(tuple, got)) == brute(rows)
    assert substring_dedup(make([])).count() == 0
