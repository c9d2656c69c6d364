"""tidemark: a change-data engine on Spark DataFrames.

Given full table extracts and an ordered log of row and schema changes,
tidemark computes the current state of every table (cell-wise merge of
inserts, updates and deletes), per-segment increment tables, snapshots,
roll-ups, column audits and monitoring tables.  Every operator is a
function from DataFrames to a DataFrame; nothing is collected to the driver.
"""

__version__ = "0.1.0"
