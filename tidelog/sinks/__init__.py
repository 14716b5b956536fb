"""Writers of stored rows, rejects, alerts and consolidated logs."""
