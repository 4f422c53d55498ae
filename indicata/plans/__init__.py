"""Rule sets, proxy inputs, composite report tables and the query catalog."""
