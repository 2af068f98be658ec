"""Landing intake, snapshots, the run log and published exports."""
