"""Oracle SQL texts (DuckDB) keyed like ``lotwright.plans.registry.REGISTRY``."""

from __future__ import annotations

from . import gold

ORACLE: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


add("gold_transform", gold.gold_sql())
add("gold_stats", gold.stats_sql())

from . import ops  # noqa: E402

for _k, _v in ops.oracles().items():
    add(_k, _v)

from . import audit  # noqa: E402

for _k, _v in audit.oracles().items():
    add(_k, _v)

from . import questions  # noqa: E402

for _k, _v in questions.oracles().items():
    add(_k, _v)

from . import pages  # noqa: E402

for _k, _v in {**pages.oracles(), **pages.payload_oracles()}.items():
    add(_k, _v)
for _k, _v in {**ops.stream_oracles(), **ops.ledger_oracles(), **ops.pipeline_oracles()}.items():
    add(_k, _v)
add("value_score", gold.value_score_sql())
for _k, _v in audit.usage_oracles().items():
    add(_k, _v)
