"""Repair of the turn structure of conversations, by alignment to the alternating grammar.

The initials of a repaired conversation's roles read ``(s?(ua)+)?``: for every length but one there
is one such string, with a leading s if the length is odd. Turns are aligned to the string of each
feasible length by the Wagner-Fischer table. The strings end alike, so one table of what it costs to
align the turns from i on with the last r letters serves all lengths, and only the leading
s is looked at apart. Ukkonen's bands keep a cell only if it may lie on a path within the
incumbent cost, that of a simple left-to-right repair. Of all cheapest scripts of all lengths
the least in ASCII order is traced back.

A conversation is aligned where its rows have been brought together and sorted; rows of many
conversations stream through a task. Of a long table only every so-many-th row is kept, the ones
between are made again when the trace comes to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import temporary

#: costs of the edits; an undeleted turn that is cut short costs CUT more
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
#: an unreachable cell; sums of a few stay in range
FAR = np.int64(1) << 60
_WHITE = " \t\n\x0b\x0c\r"


def _grammatical(pair: str) -> bool:
    return pair in ("su", "ua", "au")


class Alignment:
    """The cheapest scripts from turns to the grammar.

    ``initials`` are those of the roles, ``required`` and ``cut`` say which turns have to go
    and which cost more to keep.
    """

    def __init__(self, initials: list[str], required: list[bool], cut: list[bool]):
        self.initials, self.required, self.n = initials, required, len(initials)
        self.extra = [CUT if c else 0 for c in cut]
        # of the turns from i on, how many may stay, and how many of these are cut short
        self.may, self.cuts = [0] * (self.n + 1), [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            self.may[i] = self.may[i + 1] + (not required[i])
            self.cuts[i] = self.cuts[i + 1] + (cut[i] and not required[i])
        self.least = DELETE * (self.n - self.may[0]) + CUT * self.cuts[0]  # whatever the roles are
        self.bound = self.incumbent()
        self.step = max(1, int(self.n**0.5))
        self.kept: dict[int, tuple[int, np.ndarray]] = {}
        self.block: dict[int, tuple[int, np.ndarray]] = {}
        row = self._last()
        self.kept[self.n] = row
        for i in range(self.n - 1, -1, -1):
            row = self._above(i, row)
            if i % self.step == 0:
                self.kept[i] = row

    def incumbent(self) -> int:
        """What it costs to keep or rerole all that need not go, and close the last pair."""
        staying = [i for i in range(self.n) if not self.required[i]]
        cost = self.least
        if not staying:
            return cost
        at = 1 if len(staying) > 1 and self.initials[staying[0]] == "s" else 0
        for k, i in enumerate(staying[at:]):
            cost += 0 if self.initials[i] == "ua"[k % 2] else REROLE
        return cost + INSERT * ((len(staying) - at) % 2)

    def _band(self, i: int) -> tuple[int, int]:
        """The numbers of letters left, from and to, that a path within the bound may have at turn i.

        More letters than turns that may stay are inserted; fewer mean deleted turns, first those
        that are cut short, as they cost least more.
        """
        spare = self.bound - self.least
        cheap = min(self.cuts[i], spare // (DELETE - CUT))
        fewer = cheap + (spare - cheap * (DELETE - CUT)) // DELETE
        return max(0, self.may[i] - fewer), self.may[i] + spare // INSERT

    def _last(self) -> tuple[int, np.ndarray]:
        low, high = self._band(self.n)
        return low, np.arange(low, high + 1, dtype=np.int64) * INSERT

    def _above(self, i: int, below: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
        """Row i of the table from row i + 1: turn i is deleted, or meets the first letter left, or letters are inserted."""
        low, high = self._band(i)
        at, cells = below
        padded = np.full(high - low + 2, FAR, np.int64)  # row i + 1 from low - 1 to high
        a, z = max(low - 1, at), min(high, at + len(cells) - 1)
        if a <= z:
            padded[a - low + 1 : z - low + 2] = cells[a - at : z - at + 1]
        row = padded[1:] + DELETE
        if not self.required[i]:
            letters = np.arange(low, high + 1)
            c = self.initials[i]
            same = (letters % 2 == 1) if c == "a" else (letters % 2 == 0) if c == "u" else np.zeros(len(letters), bool)
            met = padded[:-1] + self.extra[i] + np.where(same, 0, REROLE)
            row = np.minimum(row, np.where(letters > 0, met, FAR))
        slope = np.arange(len(row), dtype=np.int64) * INSERT
        return low, np.minimum.accumulate(row - slope) + slope

    def _row(self, i: int) -> tuple[int, np.ndarray]:
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            top = min(self.n, (i // self.step + 1) * self.step)
            self.block = {top: self.kept[top]}
            for j in range(top - 1, i // self.step * self.step, -1):
                self.block[j] = self._above(j, self.block[j + 1])
        return self.block[i]

    def cost(self, i: int, r: int) -> int:
        low, cells = self._row(i)
        return int(cells[r - low]) if low <= r < low + len(cells) else int(FAR)

    def _headed(self) -> dict[int, tuple[int, int]]:
        """For odd lengths the least cost with a leading s, and the number of turns deleted before it.

        Of equally cheap places the latest is best: D comes before K.
        """
        out: dict[int, tuple[int, int]] = {}
        gone = 0
        for k in range(self.n):
            if gone > self.bound:
                break
            if not self.required[k] and self.initials[k] == "s":
                low, cells = self._row(k + 1)
                for r in range(max(2, low + low % 2), low + len(cells), 2):
                    c = gone + self.extra[k] + int(cells[r - low])
                    if c <= self.bound and (r + 1 not in out or c <= out[r + 1][0]):
                        out[r + 1] = (c, k)
            gone += DELETE
        return out

    def best(self) -> tuple[int, str]:
        """The least cost, and the ASCII-least of its scripts."""
        low, cells = self._row(0)
        plain = {r: int(cells[r - low]) for r in range(low + low % 2, low + len(cells), 2)}
        headed = self._headed()
        cost = min([*plain.values(), *[c for c, _ in headed.values()]])
        scripts = [self._trace(0, r, c) for r, c in plain.items() if c == cost]
        scripts += ["D" * k + "K" + self._trace(k + 1, m - 1, c - DELETE * k - self.extra[k]) for m, (c, k) in headed.items() if c == cost]
        return cost, min(scripts)

    def _trace(self, i: int, r: int, left: int) -> str:
        """The ASCII-least script of cost ``left`` from turn i and r letters on."""
        out = []
        while i < self.n or r:
            if i < self.n and self.cost(i + 1, r) == left - DELETE:
                out.append("D")
                i, left = i + 1, left - DELETE
            elif r and self.cost(i, r - 1) == left - INSERT:
                out.append("I")
                r, left = r - 1, left - INSERT
            else:
                same = self.initials[i] == ("u" if r % 2 == 0 else "a")
                out.append("K" if same else "R")
                left -= self.extra[i] + (0 if same else REROLE)
                i, r = i + 1, r - 1
        return "".join(out)


def repaired(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The turns after the edits of ``audit``."""
    length = len(audit) - audit.count("D")
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        letter = "s" if length % 2 and not out else "ua"[(len(out) - length % 2) % 2]
        if edit == "I":
            out.append((NAMES[letter], ""))
            continue
        role, text = turns[at]
        out.append((role if edit == "K" else NAMES[letter], text))
        at += 1
    return out


def judge(turns: list[tuple[int | None, str, str]]) -> tuple:
    """Gaps, blank, duplicate, truncated, illegal, cost, audit and the repaired turns of a conversation."""
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in turns:
        shown = text.rstrip(_WHITE)
        faults.append("b" if not shown else "d" if (role, text) in seen else "" if shown[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum([not _grammatical(a + b) for a, b in zip(initials, initials[1:])])
    cost, audit = Alignment(initials, [f in ("b", "d") for f in faults], [f == "t" for f in faults]).best()
    texts = [(role, text) for _, role, text in turns]
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, repaired(texts, audit)


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
#: characters of repaired text that are held before they are sent on
HELD = 1 << 22


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    held = 0

    def sent() -> pa.RecordBatch:
        columns = list(zip(*done))
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.string())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([[{"role": r, "text": t} for r, t in x] for x in columns[8]], _TURNS)], ["conv_id", *FIGURES, "audit", "repaired"])

    current: list[tuple] = []
    conv: object = ()  # no id is equal to it
    for b in batches:
        for conv_id, turn, role, text, there in zip(*[c.to_pylist() for c in b.columns]):
            if conv_id != conv:
                if conv != ():
                    done.append((conv, *judge(current)))
                    held += sum([len(t) for _, _, t in current]) + 1000
                    if held > HELD:
                        yield sent()
                        done, held = [], 0
                conv, current = conv_id, []
            if there:
                current.append((turn, role, text))
    if conv != ():
        done.append((conv, *judge(current)))
    if done:
        yield sent()


def repair(conversations: DataFrame, there: str | None = None) -> DataFrame:
    """Faults of each conversation and its cheapest repair.

    A turn is blank without a visible character, else a duplicate if its role and text
    came before, else truncated if its last visible character is none of ``.!?``. ``gaps`` counts missing
    turn numbers, ``illegal`` adjacent turns whose roles' initials do not follow each other.
    ``audit`` has a letter for each edit: K keeps a turn, R gives it the role user or
    assistant, D deletes it, I inserts one without text. ``repaired`` holds the turns after them.

    ``conversations`` needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Turns
    are in order of ``turn``, nulls first, equal ones by role and text; a null role or text is
    a space. Rows without a ``conv_id`` are one conversation, with a null id. If ``there``
    names a column, rows that are false there are gone, but their conversation is still listed: without
    any turn all figures are zero and nothing is repaired.
    """
    role, text, gone = temporary("role", "text", "there")
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias(role),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias(text),
        (F.col(there) if there else F.lit(True)).alias(gone),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), role, text)
    figures = ", ".join(f"{f} long" for f in FIGURES)
    return rows.mapInArrow(_judged, f"conv_id long, {figures}, audit string, repaired array<struct<role: string, text: string>>")


def damage(conversations: DataFrame, there: str) -> DataFrame:
    """Conversations with faults planted by the CRC-32 of ``conv_id:turn`` modulo 20 (a null is a space).

    0 takes the row away: it stays, with false in the new column ``there``. 1 empties its text, 2
    takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes its role user.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    (code,) = temporary("code")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(named.cast("binary")) % 20).alias(code))
    rows = rows.withColumn("text", F.when(F.col(code) == 1, "").when(F.col(code) == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col(code) == 4, "user").otherwise(F.col("role")))
    copies = F.array_repeat(F.col(code) != 0, F.when(F.col(code) == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias(there))
