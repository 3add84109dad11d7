"""Sources and sinks: corpus readers, held-out sets, block lists, count
CSVs, stage materialisation and the published lookup tables."""
