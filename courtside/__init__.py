"""Player-game tables on Spark: landed box-score JSON in, one checked row per player and game out."""
