"""Queries that apply each operator to the driver's tables, with the same in SQL.

Stand-ins: events are observations (user_id the transect, event_type the
satellite, value the position or tide, props.k a quality), orders a long series by
customer, embeddings points and spectra, lineitem a volume table.
"""
