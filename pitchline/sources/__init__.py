"""pitchline.sources"""
