"""Check queries: the same results in plain SQL over the given tables.

The relational steps are written out on their own here (windows where the Spark code
uses struct maxima, full joins where it stacks and regroups, separate sections where
it uses grouping sets), so the two sides only share the inputs and the rule tables.
"""
