"""Filter-and-aggregate queries over the Gold tables.

Groups with a null key are left out, and averages skip nulls, as an analyst's frame library does.
"""
