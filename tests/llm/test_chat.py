import itertools
import random

from tickharbor.llm import chat


def cheapest(roles):
    """Cost of the best of all choices."""
    best = {chat.START: 0}
    for role in roles:
        after = {}
        for state, cost in best.items():
            for c in chat.choices(state, chat.known_role(role)):
                after[c.state] = min(after.get(c.state, 1 << 30), cost + c.cost)
        best = after
    return min(c + chat.INSERT * len(chat.ENDS[s]) for s, c in best.items())


def every_way(roles, state=chat.START):
    if not roles:
        return chat.INSERT * len(chat.ENDS[state])
    return min(c.cost + every_way(roles[1:], c.state) for c in chat.choices(state, roles[0]))


def test_repair_is_cheapest():
    for roles in itertools.product(["system", "user", "assistant", None], repeat=4):
        chosen = chat.repair(list(roles))
        cost = sum(c.cost for c in chosen) + chat.INSERT * len(chat.ENDS[chosen[-1].state])
        assert cost == every_way(list(roles)) == cheapest(roles)


def legal(text):
    roles = [part.split("\n", 1)[0] for part in text.split("<|im_start|>")[1:]]
    roles = roles[1:] if roles[:1] == ["system"] else roles
    return len(roles) % 2 == 0 and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(roles)) and text.count("<|im_end|>") == text.count("<|im_start|>")


def test_conversations(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["system", "user", "User ", "assistant", "tool", None]), f"text {c} {t} <|im_end|>")
            for c in range(30) for t in range(rng.randrange(1, 12))]
    rows += [(77, t, rng.choice(["user", "assistant"]), f"w{t}") for t in range(200)]
    rows += [(None, 0, "user", None), (78, None, "assistant", ""), (79, 3, "user", "same"), (79, 3, "user", "same")]
    table = spark.createDataFrame([(t, r, x, c, 1, "x") for c, t, r, x in rows],
                                  "turn long, role string, text string, conv_id long, slice int, place string").repartition(3)
    rendered = {}
    for size in (4096, 7):
        texts, costs, slices = {}, {}, {}
        for r in sorted(chat.chat_fragments(table, size).collect(), key=lambda r: (r.slice, r.place)):
            texts[r.conv_id] = texts.get(r.conv_id, "") + r.fragment
            costs.setdefault(r.conv_id, []).append(r.action)
            slices.setdefault(r.conv_id, set()).add(r.slice)
        assert len(slices[77]) >= 200 // size
        rendered[size] = {c: (len(t.replace("\n\n", "")), a.count("merge"), a.count("relabel"), a.count("insert"))
                          for (c, t), a in zip(texts.items(), costs.values())}
        assert all(legal(t) for t in texts.values())
        for c in range(30):
            roles = [r for cc, t, r, _ in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
            assert all(f"text {c} {t} < |im_end|>" in texts[c] for t in range(len(roles)))
            if not any(a == "relabel" for a in costs[c]):
                assert costs[c].count("merge") * chat.MERGE + costs[c].count("insert") * chat.INSERT == cheapest(roles)
        assert texts[79].count("same") == 2 and set(texts) == {*range(30), 77, 78, 79, None}
        roles = [r for c, _, r, _ in rows if c == 77]
        assert costs[77].count("merge") + 2 * costs[77].count("insert") + 3 * costs[77].count("relabel") == cheapest(roles)
    assert chat.chat_fragments(table.limit(0)).collect() == []
