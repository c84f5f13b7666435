"""feedfold: fold semi-structured message feeds into analytical tables with Spark."""
