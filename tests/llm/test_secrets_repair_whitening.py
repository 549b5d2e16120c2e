"""Secret scans, conversation repair and whitening against brute force."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest

from dichot.llm import repair, secrets, whitening

# ------------------------------------------------------------------ secrets

KEY = 'AKIA' + "ABCDEFGH23456789"
SCHEMA = "doc_id long, text string, row string, parts string, spans string, linked string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in texts], SCHEMA)


def scanned(spark, texts, **kw):
    return [(r["doc_id"], [(s["kind"], s["start"], s["stop"]) for s in r["spans"]])
            for r in secrets.scan(docs(spark, texts), **kw).collect()]


def brute_spans(text, reach=secrets.REACH):
    """All pairs of parts of one text."""
    parts = secrets.find_parts(text or "")
    out = []
    for kind, start, stop, scope in parts:
        if kind in secrets.STRONG:
            out.append((start, secrets.KINDS.index(kind), stop))
            continue
        near = [o for o in parts if o[3] == scope and secrets.ROLES[o[0]] != secrets.ROLES[kind]
                and max(o[1] - stop, start - o[2]) < reach]
        bits = {secrets.ROLES[o[0]] for o in near} | {secrets.ROLES[kind]}
        if any(o[0] in secrets.STRONG for o in near) or len(bits) == 3:
            out.append((start, secrets.KINDS.index(kind), stop))
    return [(secrets.KINDS[k], start, stop) for start, k, stop in sorted(out)]


def test_base_spans(spark):
    texts = [(1, 'a PASSWORD = "abcdef" b'), (2, "token=abc"), (3, "token=token:abcdefgh"), (4, f"x{KEY} {'0a' * 12}"), (5, None), (6, ""),
             (7, "ü𝄞 api-key=1 apikey: zzzzzzz"), (8, "paſſword=abcdefg Key"), (None, "secret='q' secret=''qqqqqq")]
    by_id = dict(scanned(spark, texts))
    got = {t: by_id[i] for i, t in texts}
    assert got['a PASSWORD = "abcdef" b'] == [("assign", 2, 20)]
    assert got["token=abc"] == [] and got["token=token:abcdefgh"] == []
    assert got[f"x{KEY} {'0a' * 12}"] == [("access", 1, 21), ("hex", 22, 46)]
    assert got["ü𝄞 api-key=1 apikey: zzzzzzz"] == [("assign", 13, 28)]
    assert got["paſſword=abcdefg Key"] == [] and got[None] == got[""] == []


def test_weak_parts_need_company(spark):
    weak = "aZ3bY4cX5dW6eV7f"
    texts = [(1, f"just {weak} here"), (2, f"{KEY} and {weak}"), (3, f"{KEY} and\n \n{weak}"), (4, f"{KEY} {'x ' * 200}{weak}"),
             (5, f"mail a.b@example.com {weak}"), (6, f"mail a.b@example.com {weak} at https://host.example.com/x."),
             (7, "db.example.com:5432 user=admin password=abcdefg")]
    got = dict(scanned(spark, texts))
    assert got[1] == [] and got[5] == []
    assert got[2] == [("access", 0, 20), ("secret", 25, 41)]
    assert [k for k, *_ in got[3]] == ["access"] and [k for k, *_ in got[4]] == ["access"]
    assert got[6] == [("identifier", 5, 20), ("secret", 21, 37), ("endpoint", 41, 67)]
    assert got[7] == [("endpoint", 0, 19), ("identifier", 20, 30), ("assign", 31, 47)]


def test_linking_equals_all_pairs(spark):
    r = random.Random(3)
    pieces = [KEY, "password=hunter22", "user: bob", "x@y.example", "10.20.30.40", "https://a.example/b", "aZ3bY4cX5dW6eV7f", "0123456789abcdef01234567",
              "\n\n", "words " * 12, "and so on ", "db.host.example:99"]
    texts = [(i, " ".join(r.choice(pieces) for _ in range(r.randrange(40)))) for i in range(60)]
    texts += [(99, "".join(f"{KEY} aZ3bY4cX5dW6eV7f 10.20.30.{i % 250} " for i in range(400))), (100, "a" * 200_000), (101, "aB3" * 70_000 + " " + KEY),
              (7, texts[7][1]), (7, texts[8][1])]
    got = sorted(scanned(spark, texts), key=repr)
    assert got == sorted([(i, brute_spans(t)) for i, t in texts], key=repr)
    assert [s for _, s in scanned(spark, texts, reach=7)] != [s for _, s in scanned(spark, texts)]
    assert secrets.scan(docs(spark, [])).count() == 0


# ------------------------------------------------------------------ repair

def brute_repair(rows):
    """Every derivation of up to two insertions before each row and at the end."""
    best = []

    def go(i, state, cost, audit, out, hops):
        if best and cost > best[0][0]:
            return
        if i == len(rows) and state in repair.ACCEPTING:
            if not best or (cost, audit) < best[0]:
                best[:] = [(cost, audit, out)]
        if hops < 2:
            for x in "ua":
                if (state, x) in repair.STEP:
                    go(i, repair.STEP[state, x], cost + 2, audit + "I", out + [(repair.ROLE[x], "")], hops + 1)
        if i == len(rows):
            return
        role, text, wrong = rows[i]
        if wrong not in (repair.BLANK, repair.DUPLICATE):
            more = 1 if wrong else 0
            if role and (state, role[0]) in repair.STEP:
                go(i + 1, repair.STEP[state, role[0]], cost + more, audit + "K", out + [(role, text)], 0)
            for x in "ua":
                if (state, x) in repair.STEP:
                    go(i + 1, repair.STEP[state, x], cost + 2 + more, audit + "R", out + [(repair.ROLE[x], text)], 0)
        go(i + 1, state, cost + 3, audit + "D", out, 0)

    go(0, 0, 0, "", [], 0)
    return best[0]


def brute_conversation(rows):
    """Damage, faults and repair of one conversation of (conv, turn, role, text)."""
    kept = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, told = set(), []
    for _, role, text in kept:
        body = text.strip(" \t\n\v\f\r")
        wrong = (repair.BLANK if not body else repair.DUPLICATE if (role, text) in seen else None if body[-1] in ".!?" else repair.CUT)
        seen.add((role, text))
        told.append((role, text, wrong))
    turns = [t for t, *_ in kept if t is not None]
    cost, audit, out = brute_repair(told)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(w == k for *_, w in told) for k in (repair.BLANK, repair.DUPLICATE, repair.CUT)),
            sum(a[0][:1] + b[0][:1] not in repair.LEGAL for a, b in zip(told, told[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(), out)


def random_conversations(seed, n, longest):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(1, longest)):
            rows.append((conv, r.choice([turn, turn, turn, None, turn * 3]), r.choice(["user", "assistant", "system", "tool", None, ""]),
                         r.choice(["Hi.", "ok", "", None, "x y!", "\tq? \n", "Hi."])))
    return rows


@pytest.mark.parametrize("block", [1, 2, 128])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    rows = random_conversations(5, 60, 6) + [(None, 1, "user", "a."), (None, None, "assistant", "b."), (-5, 2, "user", "x")]
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    frame = spark.createDataFrame([(*row, 1) for row in rows], "conv_id long, turn long, role string, text string, gone int")
    if block == 128:
        got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(repair.damage(frame)).collect()}
        assert set(got) == set(by)
        for conv, its in by.items():
            want = brute_conversation(its)
            assert got[conv][:-1] == want[:-1] and [tuple(x) for x in got[conv][-1]] == want[-1], (conv, its)
        assert repair.repair(repair.damage(frame.limit(0))).count() == 0
    monkeypatch.setattr(repair, "BLOCK", block)
    r = random.Random(block)
    for _ in range(150):
        its = [(r.choice(["user", "assistant", "system", "tool", ""]), t, repair.fault(t, False)) for t in r.choices(["a.", "b", " "], k=r.randrange(7))]
        conv = repair.Conversation(1, True)
        for role, text, _ in its:
            conv.add(1, role, text, False)
        cost, audit, out = brute_repair(its)
        told = conv.result()
        assert told[6:8] == (cost, audit) and [(x["role"], x["text"]) for x in told[9]] == out, its


def test_long_conversation_in_blocks(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for t in range(3000)] + [(2, 1, "user", "q." * 50_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = frame.selectExpr("*", "false AS gone")
    got = {r["conv_id"]: r for r in repair.repair(plain).collect()}
    assert got[1]["audit"] == "K" * 3000 and got[1]["cost"] == 0 and len(got[1]["repaired"]) == 3000
    assert got[2]["audit"] == "KI" and got[2]["repaired_sha256"] == hashlib.sha256(("user:" + "q." * 50_000 + "\nassistant:").encode()).hexdigest()
    all_gone = repair.repair(frame.selectExpr("*", "true AS gone"), texts=False).collect()
    assert sorted(tuple(r) for r in all_gone) == [(i, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in (1, 2)]


# ------------------------------------------------------------------ whitening

def test_rank_one_updates():
    r = np.random.default_rng(1)
    for width, n in ((1, 5), (3, 2), (7, 40), (24, 200)):
        x = np.floor(r.normal(size=(n, width)) * 60)
        x[n // 2:, : width // 2] = 3                      # equal entries: deflation
        whole, left, right = (whitening.Spectrum(width) for _ in range(3))
        for i, row in enumerate(x):
            whole.add(row)
            (left if i % 3 else right).add(row)
        left.merge(right)
        scatter = (x - x.mean(0)).T @ (x - x.mean(0))
        for s in (whole, left):
            assert s.n == n and np.allclose(s.mean, x.mean(0))
            assert np.abs(s.u.T @ s.u - np.eye(width)).max() < 1e-12
            assert np.abs(s.u @ np.diag(s.d) @ s.u.T - scatter).max() <= 1e-12 * max(scatter.max(), 1) * n


def brute_whiten(vectors, k=4):
    x = np.array([np.floor(256 * np.array(v, dtype=float)).astype(int) for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    e, v = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(len(s), len(s)))
    e, v = e[::-1], v[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_whitening(spark):
    r = np.random.default_rng(2)
    good = [[float(np.float32(c)) for c in row] for row in r.normal(size=(120, 9)) * np.arange(9, 0, -1)]
    good += [good[0]] * 40 + [good[1]]
    bad = [None, [None] + [1.0] * 8, [float("nan")] * 9, [float("inf")] + [0.0] * 8]
    rows = [(i, v, "x", 1, 1.0) for i, v in enumerate(good)] + [(None, v, "x", 1, 1.0) for v in bad] + [(5, good[5], "x", 1, 1.0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, n int, whitened double").repartition(5)
    got = whitening.whiten(frame).collect()
    n, deviation, white, share = brute_whiten(good)
    assert len(got) == 4 * (len(good) + 1) and {g["n"] for g in got} == {n}
    assert all(g["identity_error"] < 1e-10 and abs(g["explained"] - share[g["component"] - 1]) < 1e-12 for g in got)
    for c in range(4):
        at = {g["vec_id"]: g for g in got if g["component"] == c + 1}
        ours = np.array([at[i]["whitened"] for i in range(len(good))])
        sign = np.sign(ours[0] * white[0, c])
        assert np.abs(ours - sign * white[:, c]).max() < 1e-9
        assert [at[i]["deviation"] for i in range(len(good))] == deviation.tolist()
    assert len(whitening.whiten(frame.union(frame)).collect()) == 2 * len(got)


def test_whitening_edges(spark):
    def run(vectors):
        return whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert run([]) == [] and run([[1.0, 2.0]]) == [] and run([[1.0], [1.0]]) == [] and run([[], []]) == []
    line = run([[0.0, 0.0], [1.0], [2.0, 0.0]])              # one direction; the short vector is filled up
    assert {r["component"] for r in line} == {1} and len(line) == 3
    assert sorted(round(abs(r["whitened"]), 6) for r in line) == [0.0, 1.224745, 1.224745]
    assert all(r["explained"] == pytest.approx(1) for r in line) and {r["n"] for r in line} == {3}
