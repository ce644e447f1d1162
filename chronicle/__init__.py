"""Chronicle: Spark jobs that turn collected pages into clean records and
collapse record histories to one row per key."""
