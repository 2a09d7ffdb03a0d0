"""The registered queries: faremill's operators over trips made of the given tables, and their SQL."""
