"""Reading extracts, stored tables, incremental loading, and adapters over other inputs."""
