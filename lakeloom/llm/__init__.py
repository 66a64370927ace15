"""Training-data operators and their queries.

Nothing outside this subpackage imports it; the entry file adds its queries when the
subpackage is present. Each module holds one operator, its query and, where SQL can say
the same thing, the oracle statement; ``catalog`` lists them.
"""
