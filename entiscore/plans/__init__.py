"""Report shaping (``report``: R1–R5) and the catalog that wires every
operator to a scale-factor directory (``catalog``)."""
