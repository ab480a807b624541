"""Connected components of a table of links, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.io import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Each round points every node at the smallest root among its own and its neighbours', for the
    root as well, then at its root's root; a chain shortens to about half. The state is written each
    round. Links with a null end are ignored. Raises if ``most_rounds`` do not settle it.
    """
    clean = links.where("a is not null and b is not null and a <> b")
    both = written(
        clean.select("a", "b").unionByName(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "components-links",
    )
    roots = written(
        both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root")
        ), "components-roots",
    )
    for _ in range(most_rounds):
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low"))
        own = roots.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "low").alias("low"))
        # A smaller root found by any node holds for the root it had, and so for all below that.
        hooks = own.where("low < root").groupBy(F.col("root").alias("r")).agg(F.min("low").alias("hook"))
        hooked = own.join(hooks, F.col("root") == F.col("r"), "left").select(
            "node", F.least("low", F.coalesce("hook", "low")).alias("root"), F.col("root").alias("old")
        )
        hooked = written(hooked, "components-hooked")
        up = hooked.select(F.col("node").alias("n"), F.col("root").alias("top"))
        following = written(
            hooked.join(up, F.col("root") == F.col("n"), "left").select(
                "node", F.least("root", F.coalesce("top", "root")).alias("root"), "old"
            ), "components-roots",
        )
        changed = following.where("root <> old").limit(1).count()
        roots = following.select("node", "root")
        if not changed:
            return roots
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
