"""Query plans over the driver's test tables.

Each plan maps a reference flow onto the TPC-H-like tables (the analogue table is in
README.md) and returns a lazy DataFrame. Plans register themselves, with their DuckDB
oracle SQL, in :mod:`medalloy.plans.registry`.
"""
