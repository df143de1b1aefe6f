"""Chat transcripts: roles recovered by a hidden Markov model, turns rendered alike.

A transcript is a sequence of blocks (messages) per conversation.  Markers at
the start of a block ("User:", "Q:", "Bot -") are evidence, not truth: they may
be missing, foreign or wrong.  Hidden states are the roles.  A block's features
are the marker's kind, the number of lines, the length and whether it ends as a
question.  Transitions, first roles and features are counted over all blocks
with a known role; log probabilities are whole millionths, so the best path's
value doesn't depend on how a conversation was cut.

Where a role is known of no block (raw transcripts), the model is learnt by Baum-Welch: it
begins with what MARKERS say (``prior``), known roles are held fixed, and expected counts
of each part are added up in Spark, EM_ROUNDS times.  ``segment`` cuts transcripts that are
one text into blocks, at lines that begin with a marker.

Order and size: blocks are range-sorted by (conversation, turn, text) and staged
in parts of about a shuffle partition.  A conversation may span many parts: each
part boils its first and last conversation down to a table (best value from
each role before it to each role at its end), the driver chains those tables
(two small rows per part), and each part then decodes with the roles at its
ends known.  So no conversation is ever gathered in one task.

Inputs: a null text is an empty block, a very long one a block like any.  A null or unknown
role trains nothing where others are known, but the block still gets a role.  Blocks with equal conversation and turn are
ordered by text, null turns first.  Null conversations form one conversation.
Equally likely paths: one of them, the same in each run.  An empty table gives an empty
one; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, stage

ROLES = ("system", "user", "assistant")
#: Speaker markers of common transcript styles.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "q", "question", "me", "customer"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "agent"),
}
SCALE = 1_000_000
EM_ROUNDS = 6
NEVER = -(1 << 60)
FEATURES = (len(MARKERS) + 1, 4, 5, 2)  # marker kind, lines, length, question
_KIND = {w: k for k, words in enumerate(MARKERS.values()) for w in words}
_MARKER = re.compile(r"\s*[\[<(*#]*\s*([A-Za-z]{1,14})\s*[\])>*]*\s*(?::|-|>)[ \t]*")


def features(text: str | None) -> tuple[tuple[int, int, int, int], str]:
    """Feature codes of a block, and its text without the marker."""
    text = text or ""
    found = _MARKER.match(text)
    kind = _KIND.get(found[1].lower(), -1) + 1 if found else 0
    body = text[found.end() :] if kind else text
    lines = min(body.count("\n"), 3)
    size = min(len(body) // 100, 99)
    length = 0 if size < 1 else 1 if size < 3 else 2 if size < 8 else 3 if size < 20 else 4
    return (kind, lines, length, int(body.rstrip().endswith("?"))), body


def segment(raw: DataFrame, conv: str = "conv_id", text: str = "text") -> DataFrame:
    """Blocks ``conv, turn, role, text`` of transcripts that are one text each: a block begins at
    the text's start and at every line that begins with a marker.  Roles are unknown."""
    words = "|".join(w for kinds in MARKERS.values() for w in kinds)
    line = r"(?im)(?=^[ \t]*[\[<(*#]*[ \t]*(?:%s)[ \t]*[\])>*]*[ \t]*(?::|-|>))" % words
    blocks = F.split(F.coalesce(F.col(text), F.lit("")), line)
    # What stands before a marker that opens the text is no block.
    full = F.when(F.size(blocks) > 1, F.filter(blocks, lambda b: F.trim(b) != "")).otherwise(blocks)
    cut = raw.select(F.col(conv).alias("conv"), F.posexplode(full).alias("turn", "text"))
    return cut.select("conv", F.col("turn").cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"), "text")


def render(role: str, body: str) -> str:
    """A turn in the canonical form."""
    return f"<|{role}|>\n{body.strip()}\n<|end|>"


class Hmm:
    """Log probabilities from counts, add-one smoothed, in SCALE-ths."""

    def __init__(self, first: np.ndarray, step: np.ndarray, seen: list[np.ndarray]):
        def logs(c: np.ndarray) -> np.ndarray:
            return np.rint(SCALE * np.log((c + 1) / (c + 1).sum(axis=-1, keepdims=True))).astype(np.int64)

        self.first, self.step, self.seen = logs(first), logs(step), [logs(s) for s in seen]

    def emit(self, codes: np.ndarray) -> np.ndarray:
        """``len(codes) x roles``."""
        return sum(s[:, codes[:, k]].T for k, s in enumerate(self.seen))

    def table(self, emit: np.ndarray, begins: bool) -> np.ndarray:
        """Best value from each role before (row; row 0 alone if the conversation
        ``begins`` here) to each role at the end."""
        n = len(ROLES)
        value = np.full((n, n), NEVER, np.int64)
        if begins:
            value[0] = self.first + emit[0]
        else:
            value = self.step + emit[0]
        for e in emit[1:]:
            value = np.maximum((value[:, :, None] + self.step[None]).max(axis=1) + e, NEVER)
        return value

    def decode(self, emit: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
        """Best roles, given the role before (None: the conversation begins) and the last one (None: free)."""
        value = (self.first if before is None else self.step[before]) + emit[0]
        back = np.zeros(emit.shape, np.int8)
        for t in range(1, len(emit)):
            came = value[:, None] + self.step
            back[t] = came.argmax(axis=0)
            value = came.max(axis=0) + emit[t]
        out = np.empty(len(emit), np.int64)
        out[-1] = int(value.argmax()) if last is None else last
        for t in range(len(emit) - 1, 0, -1):
            out[t - 1] = back[t][out[t]]
        return out


def as_transcript(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Raw transcripts of structured conversations, ``conv, turn, role, text``: by a hash
    of each message seven in ten get their role's marker, two in ten any marker
    word of any role, and the rest none."""
    pick = F.pmod(F.xxhash64(conv, turn, text, F.lit(31)), F.lit(1000))
    every = [w for words in MARKERS.values() for w in words]
    own = F.coalesce(*[F.when(F.col(role) == r, F.element_at(F.array(*map(F.lit, w)), (pick % len(w) + 1).cast("int"))) for r, w in MARKERS.items()])
    some = F.element_at(F.array(*map(F.lit, every)), (pick % len(every) + 1).cast("int"))
    marker = F.when(pick < 700, own).when(pick < 900, some)
    body = F.coalesce(F.col(text), F.lit(""))
    return conversations.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.when(marker.isNotNull(), F.concat(F.initcap(marker), F.lit(": "), body)).otherwise(body).alias("text"),
    )


def _parts(blocks: DataFrame) -> DataFrame:
    """Blocks in order, with their part and place, staged."""
    spark = blocks.sparkSession
    ordered = (
        blocks.select(F.col("conv").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(shuffle_width(spark), "conv", "turn", "tie")
        .sortWithinPartitions("conv", "turn", "text")
    )
    place = F.monotonically_increasing_id()
    return stage(ordered.select(F.spark_partition_id().alias("part"), place.alias("place"), "conv", "turn", "role", "text"), "transcript-parts")


def _columns(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray, list[str]]:
    """Rows in order: pylists, starts of conversations, feature codes and bodies."""
    rows = table.sort_by("place").to_pylist()
    conv = [r["conv"] for r in rows]
    starts = np.array([i for i in range(len(rows)) if i == 0 or conv[i] != conv[i - 1]], np.int64)
    found = [features(r["text"]) for r in rows]
    return rows, starts, np.array([f[0] for f in found], np.int64).reshape(-1, len(FEATURES)), [f[1] for f in found]


def _count(table: pa.Table) -> pa.Table:
    """Counts of one part: ``kind`` 0 first roles of conversations that begin inside the part,
    1 steps, 2.. features; and -1 for its two ends."""
    rows, starts, codes, _ = _columns(table)
    role = [ROLES.index(r["role"]) if r["role"] in ROLES else -1 for r in rows]
    begin = set(starts.tolist())
    tally: dict[tuple[int, int, int], int] = {}

    def add(kind: int, a: int, b: int) -> None:
        if a >= 0 and b >= 0:
            tally[kind, a, b] = tally.get((kind, a, b), 0) + 1

    for i, r in enumerate(role):
        if i and i in begin:
            add(0, 0, r)
        elif i:
            add(1, role[i - 1], r)
        for k in range(len(FEATURES)):
            add(2 + k, r, int(codes[i, k]))
    out = [(int(rows[0]["part"]), k, a, b, n, None) for (k, a, b), n in tally.items()]
    for end, i in ((0, 0), (1, len(rows) - 1)):
        out.append((int(rows[0]["part"]), -1, end, role[i], 0, rows[i]["conv"]))
    names = ["part", "kind", "a", "b", "n", "conv"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array([o[k] for o in out], t) for k, (n, t) in enumerate(zip(names, kinds, strict=True))})


def prior() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Counts to begin with where no role is known: a marker mostly means its role, users begin,
    users and assistants take turns."""
    n = len(ROLES)
    first, step = np.ones(n), np.ones((n, n))
    seen = [np.ones((n, f)) for f in FEATURES]
    user, assistant = ROLES.index("user"), ROLES.index("assistant")
    first[user] = 4
    step[:, user], step[user, assistant], step[assistant, user] = 4, 20, 20
    seen[0][:, 0] = 10
    for k in range(n):
        seen[0][k, k + 1] = 60
    return first, step, seen


def _expected(hmm):
    """Expected counts of a part, in SCALE-ths; a conversation's piece in it is a sequence of its own."""
    def run(table: pa.Table) -> pa.Table:
        rows, starts, codes, _ = _columns(table)
        n = len(ROLES)
        emit = hmm.value.emit(codes) / SCALE
        known = np.array([ROLES.index(r["role"]) if r["role"] in ROLES else -1 for r in rows])
        emit[(known >= 0)[:, None] & (np.arange(n) != known[:, None])] = -np.inf
        b = np.exp(emit - emit.max(axis=1, keepdims=True))
        first, step = np.exp(hmm.value.first / SCALE), np.exp(hmm.value.step / SCALE)
        gamma, begin, steps = np.empty_like(b), np.zeros(n), np.zeros((n, n))
        for lo, hi in zip(starts, [*starts[1:], len(rows)], strict=True):
            ahead = np.empty((hi - lo, n))
            for t in range(lo, hi):
                x = (first if t == lo else ahead[t - lo - 1] @ step) * b[t]
                ahead[t - lo] = x / x.sum()
            back = np.ones(n)
            for t in range(hi - 1, lo - 1, -1):
                x = ahead[t - lo] * back
                gamma[t] = x / x.sum()
                if t > lo:
                    both = ahead[t - lo - 1][:, None] * step * (b[t] * back)
                    steps += both / both.sum()
                    back = step @ (b[t] * back)
                    back /= back.sum()
            begin += gamma[lo]
        out = [(0, 0, k, begin[k]) for k in range(n)] + [(1, a, k, steps[a, k]) for a in range(n) for k in range(n)]
        for f, size in enumerate(FEATURES):
            for k in range(size):
                at = gamma[codes[:, f] == k].sum(axis=0)
                out += [(2 + f, a, k, at[a]) for a in range(n)]
        kinds = [pa.int32(), pa.int32(), pa.int32()]
        cols = {name: pa.array([o[i] for o in out], t) for i, (name, t) in enumerate(zip(("kind", "a", "b"), kinds, strict=True))}
        # Whole numbers add up alike in any order.
        return pa.table(cols | {"n": pa.array([round(SCALE * o[3]) for o in out], pa.int64())})

    return run


def learn(parts: DataFrame, rounds: int = EM_ROUNDS) -> Hmm:
    """Baum-Welch from ``prior``; roles that are known are held fixed."""
    spark = parts.sparkSession
    hmm = Hmm(*prior())
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(hmm)
        found = parts.groupBy("part").applyInArrow(_expected(held), "kind int, a int, b int, n bigint")
        first, step, seen = prior()
        for r in found.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # a few dozen
            (first if r.kind == 0 else step if r.kind == 1 else seen[r.kind - 2])[(r.b,) if r.kind == 0 else (r.a, r.b)] += r.n / SCALE
        hmm = Hmm(first, step, seen)
    return hmm


def fit(parts: DataFrame) -> Hmm:
    """From known roles; if there is a role that no block is known to have, by ``learn``."""
    known = {r.role for r in parts.where(F.col("role").isin(*ROLES)).select("role").distinct().collect()}
    return count(parts) if known == set(ROLES) else learn(parts)


def count(parts: DataFrame) -> Hmm:
    n = len(ROLES)
    first, step = np.zeros(n), np.zeros((n, n))
    seen = [np.zeros((n, f)) for f in FEATURES]
    found = stage(parts.groupBy("part").applyInArrow(_count, "part int, kind int, a int, b int, n bigint, conv bigint"), "transcript-counts")
    for r in found.where("kind >= 0").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # a few dozen
        (first if r.kind == 0 else step if r.kind == 1 else seen[r.kind - 2])[(r.b,) if r.kind == 0 else (r.a, r.b)] += r.n
    ends: dict[int, dict[int, tuple]] = {}
    for r in found.where("kind < 0").collect():  # two per part
        ends.setdefault(r.part, {})[r.a] = (r.conv, r.b)
    before = None
    for p in sorted(ends):
        conv, role = ends[p][0]
        if role >= 0 and (before is None or before[0] != conv):
            first[role] += 1
        elif role >= 0 and before[1] >= 0:
            step[before[1], role] += 1
        before = ends[p][1]
    return Hmm(first, step, seen)


TABLES = "part int, side int, conv bigint, only boolean, value array<bigint>"


def _tables(hmm):
    def run(table: pa.Table) -> pa.Table:
        rows, starts, codes, _ = _columns(table)
        emit = hmm.value.emit(codes)
        cut = [*starts.tolist(), len(rows)]
        out = []
        for side, k in ((0, 0), (1, len(starts) - 1)):
            mine = emit[cut[k] : cut[k + 1]]
            for begins in (False, True):
                out.append((rows[0]["part"], 2 * side + begins, rows[cut[k]]["conv"], len(starts) == 1, hmm.value.table(mine, begins).ravel().tolist()))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        return pa.table({n: pa.array([o[k] for o in out], t) for k, (n, t) in enumerate(zip(["part", "side", "conv", "only", "value"], kinds, strict=True))})

    return run


def chain(tables: list) -> dict[int, tuple[int | None, int | None]]:
    """For each part: the role before its first block (None: a conversation begins
    there) and the role of its last block (None: its conversation ends there)."""
    n = len(ROLES)
    parts: dict[int, dict[int, tuple]] = {}
    for t in tables:
        parts.setdefault(t.part, {})[t.side] = (t.conv, t.only, np.array(t.value, np.int64).reshape(n, n))
    order = sorted(parts)
    out: dict[int, list] = {p: [None, None] for p in order}
    i = 0
    while i < len(order):
        # A conversation that goes on: it ends part i and begins part i + 1, and so on.
        run = [i]
        while run[-1] + 1 < len(order):
            here, there = parts[order[run[-1]]], parts[order[run[-1] + 1]]
            if here[2][0] != there[0][0] or (run[-1] != i and not here[0][1]):
                break
            run.append(run[-1] + 1)
        if len(run) > 1:
            values = [parts[order[run[0]]][3][2][0]]
            for r in run[1:]:
                values.append((values[-1][:, None] + parts[order[r]][0][2]).max(axis=0))
            role = int(values[-1].argmax())
            for k in range(len(run) - 1, 0, -1):
                if k < len(run) - 1:
                    out[order[run[k]]][1] = role
                else:
                    out[order[run[k]]][1] = role if parts[order[run[k]]][0][1] else None
                role = int((values[k - 1] + parts[order[run[k]]][0][2][:, role]).argmax())
                out[order[run[k]]][0] = role
            out[order[run[0]]][1] = role
        i = run[-1] if len(run) > 1 else i + 1
        if len(run) > 1 and i == run[-1] and parts[order[i]][0][1]:
            i += 1
    return {p: (a, b) for p, (a, b) in out.items()}


def _decode(hmm, ends):
    def run(table: pa.Table) -> pa.Table:
        rows, starts, codes, bodies = _columns(table)
        emit = hmm.value.emit(codes)
        cut = [*starts.tolist(), len(rows)]
        before, last = ends.value.get(rows[0]["part"], (None, None))
        found = np.concatenate(
            [
                hmm.value.decode(emit[a:b], before if k == 0 else None, last if k == len(starts) - 1 else None)
                for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))
            ]
        )
        parsed = [ROLES[f] for f in found]
        return pa.table(
            {
                "conv": pa.array([r["conv"] for r in rows], pa.int64()),
                "turn": pa.array([r["turn"] for r in rows], pa.int64()),
                "role": pa.array([r["role"] for r in rows], pa.string()),
                "parsed_role": pa.array(parsed, pa.string()),
                "rendered": pa.array([render(p, b) for p, b in zip(parsed, bodies, strict=True)], pa.string()),
            }
        )

    return run


def parse_transcripts(blocks: DataFrame) -> DataFrame:
    """``conv, turn, role, parsed_role, rendered``, one row per block of ``conv, turn,
    role, text`` (``role`` trains the model where it is known)."""
    spark = blocks.sparkSession
    parts = _parts(blocks)
    hmm = spark.sparkContext.broadcast(fit(parts))
    tables = parts.groupBy("part").applyInArrow(_tables(hmm), TABLES).collect()  # four small rows per part
    ends = spark.sparkContext.broadcast(chain(tables))
    schema = "conv bigint, turn bigint, role string, parsed_role string, rendered string"
    return parts.groupBy("part").applyInArrow(_decode(hmm, ends), schema)
