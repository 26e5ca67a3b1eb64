"""Domain jobs: KOK (web mall), HS (TV home shopping), recipes, classification."""
