"""loomgraph: document-to-graph analytics and corpus preparation as plain Spark plans."""

__version__ = "0.1.0"
