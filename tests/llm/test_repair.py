import itertools
import random
import zlib

import pytest

from tidemark.llm import repair

BIG = 2**53 + 1
SCHEMA = "conv_id long, turn long, role string, text string"


def script_costs(initials, required, cut, most):
    """Every script with its cost whose result fits the grammar, by trying all edits."""
    out = []

    def go(i, script, letters, cost):
        if cost > most:
            return
        if i == len(initials):
            rest = letters[1:] if letters[:1] == "s" else letters
            if letters == "" or (rest and rest == "ua" * (len(rest) // 2)):
                out.append((cost, script))
        else:
            go(i + 1, script + "D", letters, cost + 4)
            if not required[i]:
                extra = 3 if cut[i] else 0
                go(i + 1, script + "K", letters + (initials[i] or "?"), cost + extra)
                for x in "ua":
                    go(i + 1, script + "R", letters + x, cost + extra + 3)
        for x in "ua":
            go(i, script + "I", letters + x, cost + 3)

    go(0, "", "", 0)
    return out


def test_alignment_equals_all_scripts():
    rng = random.Random(1)
    for n in range(6):
        for _ in range(60 if n else 1):
            initials = [rng.choice(["u", "a", "s", "x", ""]) for _ in range(n)]
            required = [rng.random() < 0.2 for _ in range(n)]
            cut = [not r and rng.random() < 0.3 for r in required]
            a = repair.Alignment(initials, required, cut)
            want = min(script_costs(initials, required, cut, a.incumbent()))
            assert a.best() == want, (initials, required, cut)


def automaton(initials, required, cut):
    """Least (cost, script) for each state of the grammar, turn by turn."""
    states = {"": (0, "")}
    step = {("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(states):
        for _ in range(3):
            for (frm, x), to in step.items():
                if frm in states:
                    c, e = states[frm]
                    states[to] = min(states.get(to, (10**9, "")), (c + 3, e + "I"))
        return states

    for i, r, t in zip(initials, required, cut):
        new = {}

        def put(to, c, e):
            new[to] = min(new.get(to, (10**9, "")), (c, e))

        for s, (c, e) in inserted(states).items():
            put(s, c + 4, e + "D")
            if not r:
                extra = 3 if t else 0
                if s == "" and i == "s":
                    put("s", c + extra, e + "K")
                for (frm, x), to in step.items():
                    if frm == s:
                        put(to, c + extra + (0 if i == x else 3), e + ("K" if i == x else "R"))
        states = new
    states = inserted(states)
    return min(states[s] for s in ("", "a") if s in states)


@pytest.mark.parametrize("n", [7, 30, 200])
def test_alignment_equals_an_automaton(n):
    rng = random.Random(n)
    for _ in range(40 if n < 100 else 8):
        initials = [rng.choice("uuuaaas") if rng.random() < 0.3 else "ua"[k % 2] for k in range(rng.randint(n // 2, n))]
        if rng.random() < 0.5:
            initials = ["s", *initials]
        required = [rng.random() < 0.15 for _ in initials]
        cut = [rng.random() < 0.2 for _ in initials]
        cut = [t and not r for t, r in zip(cut, required)]
        assert repair.Alignment(initials, required, cut).best() == automaton(initials, required, cut)


def test_bands_leave_most_cells_out():
    a = repair.Alignment(list("ua") * 500, [False] * 1000, [False] * 1000)
    assert a.best() == (0, "K" * 1000)
    assert max(len(cells) for _, cells in a.kept.values()) == 1 and len(a.kept) <= 34


def test_repair_of_rows(spark):
    rows = [
        (BIG, 1, "system", "Be kind."), (BIG, 2, "user", "Hello?"), (BIG, 3, "user", "Hello?"), (BIG, 5, "assistant", "Yes, and"),
        (None, 1, "user", "One."), (None, None, None, None),
        (3, 7, "assistant", "Alone."), (4, 1, "tool", "Odd."),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", audit string, there int").repartition(3)
    got = {r["conv_id"]: r.asDict() for r in repair.repair(df).collect()}
    assert set(got) == {BIG, None, 3, 4}
    big = got[BIG]
    assert (big["gaps"], big["blank"], big["duplicate"], big["truncated"], big["illegal"]) == (1, 0, 1, 1, 1)
    assert (big["cost"], big["audit"]) == (7, "KKDK")
    assert [tuple(t) for t in big["repaired"]] == [("system", "Be kind."), ("user", "Hello?"), ("assistant", "Yes, and")]
    none = got[None]
    assert (none["gaps"], none["blank"], none["illegal"], none["audit"]) == (0, 1, 1, "DKI")
    assert [tuple(t) for t in none["repaired"]] == [("user", "One."), ("assistant", "")]
    assert (got[3]["cost"], got[3]["audit"]) == (3, "IK")
    assert (got[4]["cost"], got[4]["audit"]) == (4, "D") and got[4]["repaired"] == []
    assert repair.repair(df.limit(0)).count() == 0


def test_damage_by_code(spark):
    rows = [(c, t, "assistant", "Yes. No!") for c, t in itertools.product(range(40), range(5))] + [(None, None, None, None)]
    got = repair.damage(spark.createDataFrame(rows, SCHEMA), "there").collect()
    want = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        text = "" if code == 1 else text.replace(".", "").replace("!", "") if code == 2 else text
        want += [(c, t, "user" if code == 4 else role, text, code != 0)] * (2 if code == 3 else 1)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    lost = repair.repair(spark.createDataFrame([(1, 1, "user", "a", False)], SCHEMA + ", there boolean"), "there").first()
    assert (lost["cost"], lost["audit"], lost["repaired"], lost["gaps"]) == (0, "", [], 0)
