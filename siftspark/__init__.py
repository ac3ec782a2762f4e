"""siftspark: molecule screening analytics as Spark DataFrame plans."""
