"""The check queries: table shapes, registered queries and their SQL."""
