"""Named queries over the tables of one folder, each with the SQL that checks it where SQL can."""

from qloom.plans import evaluation, prompts, questions, registry, relational, shop_corpus, telemetry  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
