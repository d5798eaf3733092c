"""cairn: landed JSON records to validated, curated and reported tables, on Spark."""
