"""Rule chains, pipelines and the registered queries."""
