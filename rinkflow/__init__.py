"""rinkflow: Spark-native analytics for race results and rink conditions."""
