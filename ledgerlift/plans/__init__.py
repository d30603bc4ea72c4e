"""Plans: functions from source frames to target frames, without side effects on targets."""
