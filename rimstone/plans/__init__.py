"""The lake's jobs: silver game logs, injury reports and publishing."""
