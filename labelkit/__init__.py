"""labelkit — prepare, profile, model and score labelled tables on Spark.

A table is described once by a :class:`labelkit.spec.TableSpec`; the same
cleaning then runs over parquet / CSV tables and over JSON message streams.
Everything is expressed with DataFrame expressions, MLlib and Structured
Streaming so that Catalyst plans the work.
"""

from labelkit.spec import BANK, CONTACTS, Sentinel, TableSpec

__all__ = ["BANK", "CONTACTS", "Sentinel", "TableSpec"]
