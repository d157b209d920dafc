"""Conversation repair, centroid clustering and sentence pieces against plain versions and the library."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import sha

from moonstride.llm import bisectors, conversation_repair, sentence_pieces

FOLDER = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ENDINGS = {"": "ua", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Least (cost, edits, text) over all edits, one state and row at a time, nothing pruned. Rows: role, text, fault."""
    best = {"": (0, "", [])}

    def inserted(found):
        out, todo = dict(found), list(found)
        for _ in range(3):
            for state in list(out):
                new = "a" if state == "u" else "u"
                cost, edits, lines = out[state]
                option = (cost + 2, edits + "I", [*lines, {"u": "user:", "a": "assistant:"}[new]])
                if new not in out or option[:2] < out[new][:2]:
                    out[new] = option
        return out if todo else {}

    for role, text, fault in rows:
        after = {}

        def offer(state, cost, edits, lines):
            if state not in after or (cost, edits) < after[state][:2]:
                after[state] = (cost, edits, lines)

        for state, (cost, edits, lines) in inserted(best).items():
            offer(state, cost + 3, edits + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if (role[:1] == "s" and state == "") or (role[:1] == "u" and state != "u") or (role[:1] == "a" and state == "u"):
                offer(role[:1], cost + extra, edits + "K", [*lines, f"{role}:{text}"])
            new = "a" if state == "u" else "u"
            offer(new, cost + 2 + extra, edits + "R", [*lines, f"{'assistant' if new == 'a' else 'user'}:{text}"])
        best = after
    ends = [v for s, v in inserted(best).items() if s in ("", "a")]
    cost, edits, lines = min(ends, key=lambda v: v[:2])
    return cost, edits, lines


@pytest.mark.parametrize("seed", range(12))
def test_edits_are_cheapest_and_least(seed):
    rng = random.Random(seed)
    roles = [["user", "assistant", "system"], ["tool", "user"], ["assistant"], ["user", "assistant", "human", ""], ["tool"], ["system", "s", "u"]][seed % 6]
    for length in [*range(8), 30, 200]:
        for _ in range(25 if length < 30 else 4):
            faults = rng.choice([[None], [None, None, "truncated"], [None, "truncated", "blank", "duplicate"], ["blank", "blank", "blank", None]])
            rows = [(rng.choice(roles), f"t{i}", rng.choice(faults)) for i in range(length)]
            repair = conversation_repair.Repair()
            for row in rows:
                repair.add(*row)
            cost, edits, lines = cheapest(rows)
            assert repair.finish() == (cost, edits, sha("\n".join(lines))), rows


def test_settled_edits_leave_the_tree():
    repair = conversation_repair.Repair()
    waiting = 0
    for i in range(20_000):
        fault = "blank" if i % 7 == 3 or 5_000 < i < 9_000 else None
        repair.add(("user", "assistant")[i % 2] if i % 11 else "tool", "x.", fault)
        for survivor in repair.states.values():
            node, depth = survivor.node, 0
            while node is not repair.root:
                node, depth = node.parent, depth + 1
            waiting = max(waiting, depth)
    assert waiting < 50
    assert len(repair.finish()[1]) >= 20_000


CONVERSATIONS = "conv_id long, turn long, role string, text string, audit string, dropped string, digest string, place long"


def conversation_rows():
    rng = random.Random(3)
    said = ["Yes.", "No", "Why?", "", " \t\n", None, "Why?", "x" * 50_000 + "!", "nbsp\xa0", "a\nb."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(9)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, rng.choice(said), "a", "b", "c", 7))
    return rows + rows[:7] + [(99, 0, "user", "Hi.", "a", "b", "c", 7)] * 3


def plain_damage(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        blank = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        mine = out.setdefault(conv, [])
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        role = ("user" if kind == 4 else role) or " "
        mine += [(turn, role, text)] * (kind != 0) * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    for conv, mine in plain_damage(rows).items():
        digest = lambda r: sha(f"{len(r[1])}\x00{r[1]}\x00{r[2]}")
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, judged = set(), []
        for _, role, text in mine:
            end = text.strip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, edits, lines = cheapest(judged)
        yield (conv, gaps, *counts, illegal, cost, edits, sha("\n".join(lines))), lines


def test_conversations(llm):
    rows = conversation_rows()
    table = llm.createDataFrame(rows, CONVERSATIONS)
    damaged = conversation_repair.damage(table)
    want = {w[0][0]: w for w in plain_repair(rows)}
    got = {r.conv_id: tuple(r) for r in conversation_repair.repair(damaged, damaged=True).collect()}
    assert got == {conv: w[0] for conv, w in want.items()}
    lines = {}
    for r in sorted(conversation_repair.repaired_rows(damaged, damaged=True).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {conv: w[1] for conv, w in want.items() if w[1]}


def test_no_conversations(llm):
    table = llm.createDataFrame([], CONVERSATIONS)
    assert conversation_repair.repair(table).collect() == []
    assert conversation_repair.repaired_rows(table).collect() == []


def test_a_conversation_without_rows_left(llm):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = llm.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    row = conversation_repair.repair(conversation_repair.damage(table), damaged=True).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]


def plain_clusters(rows, k, size, rounds):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == size and all(v is not None and math.isfinite(v) for v in vector):
            kept.append((vec_id, [math.floor(1024.0 * float(np.float32(v))) for v in vector]))
    order = lambda r: (r[0] is None, sha(f"3:{r[0]}"), r[1])
    centroids = [x for _, x in sorted(kept, key=order)[:k]]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min((apart(x, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        mine = {}
        for _, x in kept:
            mine.setdefault(nearest(x)[1], []).append(x)
        for n, xs in mine.items():
            centroids[n] = [sum(column) // len(xs) for column in zip(*xs)]
    found = [(i, *nearest(x)) for i, x in kept]
    longs = lambda n: n if n < 1 << 63 else None
    for i, d, n in found:
        inertia = [sum(e for _, e, m in found if m == n), sum(e for _, e, _ in found)]
        text = ",".join(map(str, centroids[n]))
        yield i, n, longs(d), *map(longs, inertia), hashlib.sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, numbers array<double>, packed binary, `cluster` int"


@pytest.mark.parametrize("reach", [1.0, 1e5, 1e30])
def test_clusters(llm, reach):
    rng = np.random.RandomState(4)
    vector = lambda: [float(np.float32(v)) for v in rng.standard_normal(4) * reach]
    rows = [(i, vector()) for i in range(150)]
    rows += [(3, rows[3][1]), (3, vector()), (None, vector()), (None, vector()), (900, None), (901, []), (902, [1.0] * 5)]
    rows += [(903, [1.0, None, 2.0, 3.0]), (904, [float("nan"), 1.0, 1.0, 1.0]), (905, [float("inf"), 1.0, 1.0, 1.0])]
    rows += [(910 + i, rows[7][1]) for i in range(40)] + [(960, [0.0, -0.0, -1e-9, 1e-9])]
    table = llm.createDataFrame([(i, v, 1, None, None, 2) for i, v in rows], VECTORS).repartition(3)
    found = bisectors.cluster(table, k=5, size=4, rounds=4)
    got = found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(plain_clusters(rows, 5, 4, 4), key=key)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(llm, n):
    rows = [(i, [1.0, 2.0 + i]) for i in range(n)]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = bisectors.cluster(table, k=5, size=2).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(i, 0) for i in range(n)]
    assert {r.inertia for r in got} <= {0}


def test_equal_distances_go_to_the_smaller_number():
    model = bisectors.Tournament([[0, 0], [2, 0], [0, 2], [2, 2]])
    best, apart = model.assign(np.array([[1, 1], [2, 1], [0, 2], [3, 3]]))
    assert best.tolist() == [0, 1, 2, 3] and apart == [2, 1, 0, 2]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("name", ["tricky", "documents", "nothing"])
def test_sentence_pieces(name, llm, tricky, nothing, library):
    docs = {"tricky": tricky, "nothing": nothing}.get(name) or llm.read.parquet(f"{FOLDER}/documents.parquet")
    want = []
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row.text or "")
        decoded = library.decode(ids)
        want.append((row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded), ids, decoded))
    got = sentence_pieces.encode_and_decode(docs, MODEL, with_ids=True, with_text=True).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("seed", range(3))
def test_pieces_of_odd_texts(seed, library):
    rng, model = random.Random(seed), sentence_pieces.piece_model(MODEL)
    vocabulary = list(model.id_of)
    odd = ["a", "e", "th", " ", "  ", "▁", "\n", "\x00", "\t", "é", "日本", "\U0001f600", "​", "�", "<s>", "<0x41>", "\x85", "ﷺ", "क्षि", "벨"]
    makers = [
        lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(30))),
        lambda: "".join(rng.choice(vocabulary) for _ in range(rng.randrange(8))),
        lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzeeettaa") for _ in range(rng.randrange(80))),
        lambda: "".join(rng.choice("  ▁ tea\n") for _ in range(rng.randrange(60))),
    ]
    texts = [rng.choice(makers)() for _ in range(2000)] + ["ab" * 50_000, "日本" * 20_000, " " * 1000]
    for text in texts:
        decimals, packed, decoded = model.encode_and_decode(text)
        ids = library.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert decimals == ",".join(map(str, ids))
        assert decoded == model.decode(packed) == library.decode(ids), text
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), 28705]) for _ in range(rng.randrange(6))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids
