"""catalogloom: dataset derivation, reconciliation and faceted querying as Spark plans."""
