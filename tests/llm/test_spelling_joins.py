"""Words never pass through the driver, however small Spark takes their table for."""

import random

from faremill.llm import spelling
from tests.llm.rows import documents


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    draw = random.Random(8)
    stems = ["".join(draw.choice("abcde") for _ in range(draw.randint(5, 8))) for _ in range(200)]
    rows = [(i, None, None, None, " ".join(draw.choices(stems, k=80))) for i in range(60)]
    plans, stored = [], spelling.stored

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(spelling, "stored", watched)
    found = spelling.variants(documents(spark, rows), most=20)
    plans.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    assert {"spelling-groups", "spelling-forms", "spelling-pointers", "result"} <= {name for name, _ in plans}
    joined = [name for name, plan in plans if "Join" in plan]
    assert len(joined) >= 4 and not [name for name, plan in plans if "Broadcast" in plan]
    assert found.count() == spelling.word_counts(documents(spark, rows)).count()
