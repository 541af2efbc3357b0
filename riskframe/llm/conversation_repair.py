"""Conversation structure repair: the cheapest edits that give a conversation its form back.

A repaired conversation is empty or has an optional system turn and then one or more pairs of a user and
an assistant turn. A row can be kept (cost 0), given the role user or assistant (3) or deleted (4, the
only choice for blank and duplicate rows); an empty user or assistant turn can be inserted anywhere (3); a
truncated row that stays adds 3. Of the cheapest repairs the one whose audit (the initials of its edits
in order) comes first in ASCII is taken. The audit fixes the result: with the number of turns it
tells whether a system turn leads, and so every role.

The dynamic program has four states (nothing yet, after the system turn, after a user turn, after an
assistant turn) and keeps one cheapest edit prefix for each. Prefixes are persistent: an edit is a node
linked to the node before it, so states share what they have in common. A node has ancestors at
distances of powers of two and a rolling hash of its prefix. Two prefixes of equal cost are compared by
searching their longest common prefix with these hashes; the nodes found are verified edit by edit back
to a shared node, and if hashes had collided the plain comparison decides. Equal cost rules out that one
prefix begins the other, as further edits would have cost more, so the smaller prefix stays smaller
whatever follows.

Rows are dealt out by conversation, sorted by turn and streamed: a conversation is never collected. Its
repaired text is hashed on the way, one running SHA-256 for each state, so no text is kept either, and
edits that all states share are moved to a plain string every ``SETTLE`` rows. A SHA-256 has to read its
conversation in order, so one conversation is one task's stream; repeated turns, for which a stream would
have to remember all turns, are found before by a window over conversation, role and text.

Defined results: nulls in role or text, and in the names that decide the damage, are one space; null
turns come first and count in no gap; turns are ordered by turn, role and text, so ties and repeated
rows have a fixed order; rows without conversation are one conversation; roles that do not begin with
s, u or a cannot be kept; very long texts are hashed as they stream; an empty table gives an empty table;
extra columns are not read.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAMAGES = 20
#: Rows after which shared edits are settled, and the memory of their nodes is returned.
SETTLE = 4096

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: From a state, the role initial that may follow and the state it leads to.
FOLLOWS = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
LEGAL = {"su", "ua", "au"}

SPACE = " \t\n\x0b\x0c\r"
_HASH_BASE, _HASH_PRIME = 1_000_003, (1 << 61) - 1

_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
_COLUMNS = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: ``conv_id``, ``turn``, ``role``, ``text``, and ``gone`` for dropped rows.

    ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats
    it, 4 makes it the user's. Dropped rows stay as marks without text, so that no conversation is lost.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.encode(F.concat_ws(":", *names), "utf-8")) % DAMAGES
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        kind.alias("kind"), role.alias("role"), text.alias("text"),
    )
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with their first ``fault``: blank, duplicate or truncated, else null."""
    # a window over conversation, role and text: hot conversations are spread, nothing is gathered
    same = Window.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    spoken = F.rtrim("text", F.lit(SPACE))
    return rows.select("*", F.row_number().over(same).alias("_time")).select(
        "conv_id", "turn", "role", "text", "gone",
        F.when(F.col("gone"), F.lit(None).cast("string"))
        .when(spoken == "", "blank")
        .when(F.col("_time") > 1, "duplicate")
        .when(~F.substring(spoken, -1, 1).isin(".", "!", "?"), "truncated").alias("fault"),
    )


class Edits:
    """Edit prefixes as linked nodes with binary-lifting ancestors and rolling hashes; node 0 is empty."""

    def __init__(self):
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, before: int, edit: str) -> int:
        """The node of the prefix ``before`` followed by ``edit``."""
        node, up = len(self.edit), [before]
        while len(up) <= len(self.up[up[-1]]):
            up.append(self.up[up[-1]][len(up) - 1])
        self.edit.append(edit)
        self.depth.append(self.depth[before] + 1)
        self.hash.append((self.hash[before] * _HASH_BASE + ord(edit)) % _HASH_PRIME)
        self.up.append(up)
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        while (far := self.depth[node] - depth) > 0:
            node = self.up[node][far.bit_length() - 1]
        return node

    def text(self, node: int, above: int = 0) -> str:
        """The edits from below ``above`` to ``node``."""
        out = []
        while node != above:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def precedes(self, x: int, y: int) -> bool:
        """Whether the prefix ``x`` is ASCII-less than ``y``."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.lifted(x, depth), self.lifted(y, depth)
        if self.hash[a] == self.hash[b]:
            return self.depth[x] < self.depth[y] if self._same(a, b) else self.text(x) < self.text(y)
        for k in reversed(range(len(self.up[a]))):
            # an ancestor 2^k away exists for both or for neither: they are equally deep
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.edit[a] == self.edit[b] or not self._same(self.up[a][0], self.up[b][0]):
            return self.text(x) < self.text(y)  # hashes collided
        return self.edit[a] < self.edit[b]

    def _same(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length are equal, edit by edit back to a shared node."""
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def shared(self, nodes: list[int]) -> int:
        """The deepest node that lies on the way to all ``nodes``."""
        first = nodes[0]
        for other in nodes[1:]:
            depth = min(self.depth[first], self.depth[other])
            a, b = self.lifted(first, depth), self.lifted(other, depth)
            for k in reversed(range(len(self.up[a]))):
                if k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                    a, b = self.up[a][k], self.up[b][k]
            first = a if a == b else self.up[a][0]
        return first

    def settled(self, nodes: list[int]) -> "tuple[str, list[int], Edits]":
        """The edits that all ``nodes`` share, and the nodes among edits that hold only what follows."""
        root = self.shared(nodes)
        left, new = Edits(), {root: 0}
        for node in nodes:
            way = []
            while node not in new:
                way.append(node)
                node = self.up[node][0]
            for below in reversed(way):
                new[below] = left.add(new[self.up[below][0]], self.edit[below])
        return self.text(root), [new[n] for n in nodes], left


class Repair:
    """The cheapest repair of one conversation, fed row by row."""

    def __init__(self):
        self.edits, self.done, self.rows = Edits(), [], 0
        # state -> (cost, node, hash of the repaired turns so far, whether there are any)
        self.states = self._inserted({NOTHING: (0, 0, hashlib.sha256(), False)})

    def _offer(self, states: dict, state: int, cost: int, before: tuple, edit: str, turn: str | None) -> bool:
        """Put a prefix into ``states`` if it is the best of its state so far."""
        best = states.get(state)
        if best and best[0] < cost:
            return False
        node = self.edits.add(before[1], edit)
        if best and best[0] == cost and not self.edits.precedes(node, best[1]):
            return False
        digest, any_turn = before[2], before[3]
        if turn is not None:
            digest = digest.copy()
            digest.update(f"\n{turn}".encode() if any_turn else turn.encode())
            any_turn = True
        states[state] = (cost, node, digest, any_turn)
        return True

    def _inserted(self, states: dict) -> dict:
        """Insertions after each state, cheapest first, until none is better."""
        waiting = sorted(states, key=lambda s: states[s][0])
        while waiting:
            state = waiting.pop(0)
            for to in FOLLOWS[state].values():
                if to != SYSTEM and self._offer(states, to, states[state][0] + COST[INSERT], states[state], INSERT, f"{ROLE[to]}:"):
                    waiting.append(to)
        return states

    def feed(self, role: str, text: str, fault: str | None) -> None:
        after: dict = {}
        rest = TRUNCATED_COST if fault == "truncated" else 0
        for state, before in self.states.items():
            self._offer(after, state, before[0] + COST[DELETE], before, DELETE, None)
            if fault in ("blank", "duplicate"):
                continue
            for initial, to in FOLLOWS[state].items():
                if role.startswith(initial):
                    self._offer(after, to, before[0] + COST[KEEP] + rest, before, KEEP, f"{role}:{text}")
                elif to != SYSTEM:
                    self._offer(after, to, before[0] + COST[REROLE] + rest, before, REROLE, f"{ROLE[to]}:{text}")
        self.states = self._inserted(after)
        self.rows += 1
        if self.rows % SETTLE == 0:
            names = list(self.states)
            done, nodes, self.edits = self.edits.settled([self.states[s][1] for s in names])
            self.done.append(done)
            for s, node in zip(names, nodes, strict=True):
                cost, _, digest, any_turn = self.states[s]
                self.states[s] = (cost, node, digest, any_turn)

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the repaired turns."""
        ends = [self.states[s] for s in (NOTHING, ASSISTANT) if s in self.states]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or other[0] == best[0] and self.edits.precedes(other[1], best[1]):
                best = other
        return best[0], "".join(self.done) + self.edits.text(best[1]), best[2].hexdigest()


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.repair, self.counts = conv_id, Repair(), {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.low = self.high = self.role = None

    def feed(self, turn, role, text, gone, fault) -> None:
        if gone:
            return
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.role is not None and self.role[:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.role = role
        if fault:
            self.counts[fault] += 1
        self.repair.feed(role, text, fault)

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        cost, audit, digest = self.repair.result()
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, audit, digest)


def _stream(batches):
    now, rows = None, []

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA
        )

    for b in batches:
        for conv_id, *row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
            if now is None or now.conv_id != conv_id:
                if now:
                    rows.append(now.row())
                now = _Conversation(conv_id)
            now.feed(*row)
        if rows:
            yield batch()
            rows = []
    if now:
        rows = [now.row()]
        yield batch()


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (as from ``damaged``): its faults, cheapest edits and result."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text"]
    return with_faults(rows).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_stream, _COLUMNS)
