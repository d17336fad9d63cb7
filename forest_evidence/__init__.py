"""Forest-loss and land-parcel evidence on Spark."""
