"""Print a compact final physical plan (operators only) for registered queries.

Usage: python scripts/plan_digest.py [--no-auto-broadcast] [sf_dir] [query ...]
Runs each query once so the adaptive plan is final, then prints its operator tree; with
``--no-auto-broadcast`` it lists only the shuffles, as planned when no side is small.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dialstat.plans.catalog import HEADLINE, QUERIES  # noqa: E402
from dialstat.session import local_session  # noqa: E402

_DETAIL = re.compile(r"\s*(\[.*|\(.*|isFinalPlan.*|#\d+.*)$")


def _strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def _summarise(body: str) -> str:
    join = re.match(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[(.*?)\], \[(.*?)\], (\w+)(?:, (Build\w+))?", body)
    if join:
        name, lk, rk, kind, build = join.groups()
        return f"{name} {kind}{' ' + build if build else ''} on {_strip_ids(lk)} = {_strip_ids(rk)}"
    exch = re.match(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)(?:\((.*), \d+\))?, ", body)
    if exch:
        return f"Exchange {exch.group(1)}({_strip_ids(exch.group(2) or "")})"
    agg = re.match(r"HashAggregate\(keys=\[(.*?)\], functions=\[(.*?)\]", body)
    if agg:
        return f"HashAggregate keys=[{_strip_ids(agg.group(1))}] fns=[{_strip_ids(agg.group(2))[:60]}]"
    wgl = re.match(r"WindowGroupLimit \[(.*?)\].*?(\d+), (Partial|Final)", body)
    if wgl:
        return f"WindowGroupLimit by [{_strip_ids(wgl.group(1))}] n={wgl.group(2)} {wgl.group(3)}"
    if body.startswith("TakeOrderedAndProject"):
        lim = re.search(r"limit=(\d+)", body)
        return "TakeOrderedAndProject" + (f" limit={lim.group(1)}" if lim else "")
    return _DETAIL.sub("", body)


def digest(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if "Initial Plan" in line:
            break
        if not line.strip() or "Final Plan" in line:
            continue
        m = re.match(r"^([\s:|+\-]*)(.*)$", line)
        prefix, body = m.group(1), m.group(2)
        body = re.sub(r"^\*\(\d+\) ", "", body)
        if body.startswith("FileScan parquet"):
            table = re.search(r"/([a-z_]+)\.parquet", body)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", body)
            body = f"Scan {table.group(1) if table else '?'}" + (
                f" pushed=[{pushed.group(1)}]" if pushed and pushed.group(1) else ""
            )
        else:
            body = _summarise(body)
        if body in ("ColumnarToRow", "InputAdapter", "WholeStageCodegen"):
            continue
        out.append(prefix + body)
    return out


def main() -> None:
    args = sys.argv[1:]
    shuffles_only = "--no-auto-broadcast" in args
    args = [a for a in args if a != "--no-auto-broadcast"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(HEADLINE)
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    if shuffles_only:
        # The shape at scale: no side is small enough for the planner to broadcast, so only
        # explicit, size-checked broadcasts remain.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name in names:
        df = QUERIES[name][0](spark, sf_dir)
        df.collect()
        lines = digest(df._jdf.queryExecution().executedPlan().toString())
        if shuffles_only:
            keys = [ln.strip(" :|+-") for ln in lines if "Exchange hashpartitioning" in ln or "ReusedExchange" in ln]
            print(f"- `{name}`: {len(keys)} shuffles: " + ", ".join(k.replace("Exchange hashpartitioning", "") for k in keys))
            continue
        print(f"### {name}\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
