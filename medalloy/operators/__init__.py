"""DataFrame → DataFrame operators (lazy; no counts or collects inside). Two operators
materialise a reused intermediate with a reliable checkpoint in the shared checkpoint dir:
``upsert.dense_positions`` (one range partitioning for ranks and offsets) and
``matching.best_match`` (the distinct name and title sets feeding five candidate branches)."""
