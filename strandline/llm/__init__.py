"""Operators for preparing language-model training data at scale.

Nothing else in the library imports this subpackage; the driver's registry adds
its queries only when it can be imported.
"""
