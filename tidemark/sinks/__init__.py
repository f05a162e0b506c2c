"""Writers for the offline log, the online view, snapshots and prediction logs."""
