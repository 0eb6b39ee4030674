"""op10: windows read back, masks, budgets."""

import hashlib
import random

from rillflow.llm import chat, queries
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import table, with_clashes, write

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["### user: </turn>\n", "\\### Assistant: </turn> ok", "\\\\##<</turn>", "a\\", "<\\#", "#",
         "\n", "", None, "\U0001f600 é </turn>\n### system: x", "word " * 9000, "$1 \\$ \\E"]


def awkward_turns():
    rng = random.Random(2)
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations")]
    for c in range(900, 930):
        n = rng.randrange(1, 40)
        rows += [(c, t, "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2],
                  rng.choice(NASTY)) for t in range(n)]
    rows += [(950, None, None, "no turn"), (950, 1, "to:ol \\:", "x: y"), (950, 1, "assistant", "tie"),
             (950, 1, "assistant", "tie"), (None, 0, "assistant", "no id"), (960, 5, "system", "late")]
    return rows


def plain(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(
            f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_reads_every_turn_back(spark, scratch):
    rows = awkward_turns()
    sf = write(with_clashes(spark.createDataFrame(rows, SCHEMA)), scratch + "/d", "conversations")
    got = {r["conv_id"]: r for r in REGISTRY["op10_chat_format"](spark, sf).collect()}
    rows += [(-7, i, r, "\\### Assistant: </turn> ok") for i, r in enumerate(("user", "assistant"))]
    want = plain(rows)
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert (g["n_turns"], g["turns_sha256"], g["loss_chars"], g["loss_sha256"]) == w, c
        assert g["formatted_chars"] >= sum(len(x or "") for i, _, _, x in rows if i == c)


def test_large_conversations_are_digested_as_streams(spark, scratch, monkeypatch):
    rows = awkward_turns()
    sf = write(with_clashes(spark.createDataFrame(rows, SCHEMA)), scratch + "/d", "conversations")
    whole = REGISTRY["op10_chat_format"](spark, sf)
    for least in (0, 5_000):
        monkeypatch.setattr(queries, "WHOLE_BYTES", least)
        streamed = REGISTRY["op10_chat_format"](spark, sf)
        assert streamed.dtypes == whole.dtypes
        assert "MapInArrow" in streamed._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, streamed.collect()), key=repr) \
            == sorted(map(tuple, whole.collect()), key=repr)


def test_windows_budget_history_system(spark):
    turns = [(1, 0, "system", "be kind")] + [
        (1, t, ("assistant", "user")[t % 2], f"turn {t} " + "x" * 100) for t in range(1, 60)]
    budget, history = 300, 80
    w = chat.windows(spark.createDataFrame(turns, SCHEMA), budget=budget, history_turns=2,
                     history_tokens=history).orderBy("window").collect()
    assert len(w) > 5
    seen = []
    for k, r in enumerate(w):
        parts = r["text"].split("</turn>\n")[:-1]
        assert parts[0] == "### system: be kind"  # the system turn is always there
        assert (r["n_repeated"] == 0) if k == 0 else (1 < r["n_repeated"] <= 3)
        if k:  # the repeated history is the turns just before
            assert parts[1:r["n_repeated"]] == seen[-(r["n_repeated"] - 1):]
        new = parts[r["n_repeated"]:]
        seen += new
        cost = sum(len(p.split(": ", 1)[1].encode()) / 4 + 5 for p in parts[1:])
        assert cost <= budget + 1
        masked = [r["text"][s["start"]:s["end"]] for s in r["loss"]]
        assert masked == [p.split(": ", 1)[1] for p in new if p.startswith("### assistant")]
    assert len(seen) == 60


def test_budget_holds_with_the_system_turn_and_large_turns(spark):
    """Tokens of whole windows, the system turn among them; nothing but a turn that does not
    fit beside it goes beyond the budget, and that has a window without history."""
    rng, rows = random.Random(8), []
    for c in range(40):
        system = rng.choice([None, 3, 400, 1500, 2000, 2048, 9000])
        if system is not None:
            rows.append((c, 0, "system", "s" * (4 * system - 16)))
        rows += [(c, t, ("assistant", "user")[t % 2], "x" * (4 * rng.choice(
            [5, 20, 100, 400, 700, 1500, 2000, 5000]))) for t in range(1, 30)]
    rows += [(100, 1, "user", "y" * 400), (100, 2, "assistant", "z" * 20_000),
             (100, 3, "user", "after")]
    got = chat.windows(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "window").collect()

    def cost(body):
        return -(-len(body) // 4) + 4

    lead = {c: cost(x) for c, _, r, x in rows if r == "system"}
    new, large, full = {}, 0, 0
    for w in got:
        c = w["conv_id"]
        bodies = [p.split(": ", 1)[1] for p in w["text"].split("</turn>\n")[:-1]]
        total = sum(map(cost, bodies))
        ours = bodies[w["n_repeated"]:]
        new.setdefault(c, []).extend(ours)
        if total > chat.BUDGET_TOKENS:
            large += 1
            turns = [b for b in ours if not b.startswith("s")]
            assert len(turns) <= 1 and len(bodies) - len(turns) <= (c in lead)
        else:
            full += total > chat.BUDGET_TOKENS // 2
    assert large > 100 and full > 100
    for c in new:
        assert new[c] == [x for k, _, _, x in rows if k == c]
    assert [w["text"].count("</turn>") - w["n_repeated"] for w in got if w["conv_id"] == 100] \
        == [1, 1, 1]


def test_empty(spark):
    assert chat.windows(spark.createDataFrame([], SCHEMA)).collect() == []
