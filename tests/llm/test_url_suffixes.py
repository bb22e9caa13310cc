"""Pages that no rule decides are not judged by the rule of others of their suffix."""

import random

from sigweave.llm import urls


def test_one_rule_does_not_judge_its_whole_suffix(spark):
    rng = random.Random(8)

    def host():
        return "".join(rng.sample("example", 7))

    def tail():
        return "".join(rng.choices("abcdefgh0123", k=rng.randint(3, 30)))

    found = [f"x://{'example.com'}/de/{tail()}" for _ in range(200)]
    found += [f"x://{host()}.org/fr/{tail()}" for _ in range(200)]
    found += [f"x://{host()}.{s}/{p}/{tail()}" for s in ("com", "org") for p in ("fi", "se") for _ in range(100)]
    pages = spark.createDataFrame(list(enumerate(f for f in found)), "page_id long, url string")
    free = [r for r in urls.judge(pages).collect() if r.rule is None]
    share = {}
    for s in ("com", "org"):
        verdicts = [r.verdict == "block" for r in free if r.host.endswith(s)]
        assert len(verdicts) >= 199
        share[s] = sum(verdicts) / len(verdicts)
    assert abs(share["com"] - share["org"]) < 0.5


def test_rate_leaves_out_the_own_host(spark):
    rows = [("a.x", 1, "r"), ("a.x", 1, "r"), ("b.y", 0, "q"), ("b.y", 1, "r")]
    known = spark.createDataFrame(rows, "host string, blocked int, rule string")
    held = {(r.host): r.suffix_rate for r in urls.with_suffix_rate(known, known, True).collect()}
    full = {(r.host): r.suffix_rate for r in urls.with_suffix_rate(known, known).collect()}
    # x has one rule only; y has two but a single host, which is left out.
    assert held == {"a.x": 0.75, "b.y": 0.75}
    assert full == {"a.x": 0.75, "b.y": (1 + 5 * 0.75) / 7}
