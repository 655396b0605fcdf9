"""Writers. Every table is partitioned down to the run, so a rerun replaces exactly its own rows."""
