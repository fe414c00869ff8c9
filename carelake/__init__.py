"""carelake: clinical (FHIR R4) lakehouse analytics expressed as Spark jobs."""
